"""Quality, licences, toxicity and secrets: held-out accuracy, brute force, odd rows."""

import duckdb
import pytest
from brute import base_secrets, licence_labels
from pyspark.sql import functions as F

from seekframe.llm.licenses import TEMPLATES, licenses_digest, licenses_sql, scan_licenses
from seekframe.llm.quality import fit_quality, held_out, quality_digest, score_quality
from seekframe.llm.secrets import scan_secrets, secrets_digest
from seekframe.llm.toxicity import fit_toxicity, reject_toxic, score_toxicity, toxicity_digest

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")


def test_quality_on_rows_that_taught_nothing(small):
    docs, labels = small
    got = quality_digest(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert sum(r["predicted"] == r["quality"] for r in got) / len(got) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_is_crc_of_the_id(spark):
    import zlib
    got = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


def test_quality_odd_rows(odd, labels, no_labels, none):
    got = quality_digest(odd, labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 8 or r["doc_id"] in (1, 2)}) <= 2
    assert {r["score"] for r in quality_digest(odd, no_labels).collect()} == {0.5}
    assert quality_digest(none, labels).count() == 0
    m = fit_quality(none, labels)
    assert {r["score"] for r in score_quality(odd, m).collect()} == {0.5}


@pytest.fixture(scope="module")
def taught(spark):
    """Two kinds of text, labelled; ids 0 and 1 stand beside several texts each."""
    import random
    rng = random.Random(8)
    good = [" ".join(rng.choices([f"plain{i}" for i in range(60)], k=60)).capitalize() + "." for _ in range(60)]
    bad = [" ".join(rng.choices(["BUY!!!", "c$sh", "###", "win99", "cl1ck"], k=40)) for _ in range(60)]
    texts = good[:30] + bad[:30]
    rows = list(enumerate(texts)) + [(0, bad[40]), (0, good[41]), (1, bad[42]), (500, good[50]), (501, bad[50]), (502, good[50])]
    labels = [(i, int(i < 30), 0) for i in range(60)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_is_the_same_in_any_order(spark, taught):
    docs, labels = taught
    first = {(r["doc_id"], r["score"]) for r in score_quality(docs, fit_quality(docs, labels)).collect()}
    by = {}
    for i, x in first:
        by.setdefault(i, set()).add(x)
    assert by[500] == by[502] and len(by[500]) == 1 and min(by[500]) > 0.8 > 0.2 > max(by[501])
    for parts in (1, 5):
        again = docs.orderBy(F.rand(parts)).repartition(parts)
        got = {(r["doc_id"], r["score"]) for r in score_quality(again, fit_quality(again, labels.repartition(3))).collect()}
        assert {(i, round(x, 5)) for i, x in got} == {(i, round(x, 5)) for i, x in first}


def test_votes_against_brute_force(taught):
    import math

    import numpy as np

    from seekframe.llm.quality import Features, matrix
    docs, labels = taught
    m = fit_quality(docs, labels, k=7)
    assert m.vectors.shape[1] == m.project.shape[1] <= 64
    rows = docs.select("doc_id", "text").distinct().collect()
    got = {(r["doc_id"], r["score"]) for r in score_quality(docs, m).collect()}
    f = Features()
    want = set()
    for r in rows:
        v = (matrix([f(r["text"])])[0].astype(float) @ m.project.astype(float)).tolist()
        size = math.sqrt(sum(x * x for x in v))
        cosines = sorted(((sum(a * b for a, b in zip(v, u)) / size, i) for i, u in enumerate(m.vectors.tolist())), reverse=True)[:7]
        votes = [(max(c, 0) ** m.power * m.weights[i], m.labels[i]) for c, i in cosines]
        one, total = sum(w * y for w, y in votes), sum(w for w, _ in votes)
        want.add((r["doc_id"], (one + 0.01 * m.prior) / (total + 0.01)))
    assert len(got) == len(want) and np.allclose([x for _, x in sorted(got)], [x for _, x in sorted(want)], atol=1e-4)


def test_latent_directions_without_weight_go():
    import numpy as np

    from seekframe.llm.quality import Features, fit_matrix, matrix
    f = Features()
    x = matrix([f("one text alone")] * 6)
    m = fit_matrix(x, np.array([0, 1, 0, 1, 1, 0]), 0.5, dims=64, k=3, power=8.0)
    assert m.project.shape[1] == 1


def test_toxicity_finds_labelled_toxic_texts(small):
    docs, labels = small
    model = fit_toxicity(docs, labels)
    got = score_toxicity(docs, model).join(labels, "doc_id").collect()
    toxic = [r for r in got if r["toxic"] == 1]
    # 4 to 6 toxic texts in each of three languages are too few to learn their words; English has 36
    assert sum(r["severity"] >= 0.5 for r in toxic if r["lang"] == "en") >= 0.9 * sum(r["lang"] == "en" for r in toxic) > 0
    assert sum(r["severity"] >= 0.5 for r in got if r["toxic"] == 0) <= 0.01 * len(got)
    assert all(0 <= r["severity"] <= 3 and r["grade"] in (0, 1, 2, 3) for r in got)
    kept = reject_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == score_toxicity(docs, model).filter("severity < 0.5").count()


def test_toxicity_on_texts_that_taught_nothing(small):
    docs, labels = small
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = score_toxicity(docs, fit_toxicity(docs, labels, teaches=half)).join(labels, "doc_id").filter(~half).collect()
    toxic, clean = ([r["severity"] >= 0.5 for r in got if r["toxic"] == y] for y in (1, 0))
    # 28 toxic texts teach four languages here
    assert sum(toxic) >= 0.6 * len(toxic) > 0 and sum(clean) <= 0.01 * len(clean)


def test_ordinal_thresholds_stay_ordered_and_share_weights():
    import numpy as np

    from seekframe.llm.toxicity import fit_ordinal
    rng = np.random.default_rng(1)
    x = rng.random((400, 3))
    y = np.digitize(x @ [4.0, 2.0, 0.0], [1.5, 3.0, 4.5])
    w, theta = fit_ordinal(x, y, steps=1500)
    assert theta[0] <= theta[1] <= theta[2] and w[0] > w[1] > abs(w[2])
    z = x @ w
    expected = sum(1 / (1 + np.exp(t - z)) for t in theta)
    assert np.corrcoef(expected, y)[0, 1] > 0.9


def test_toxicity_sample_takes_turns_by_language(spark):
    """A language with 1 of 60 toxic texts is learnt although the sample holds far fewer than there are."""
    rows, labels = [], []
    for i in range(4000):
        lang = "xx" if i % 40 == 0 else "en"
        toxic = i % 80 < 41 and i % 2 == 0 if lang == "en" else i % 80 == 0
        filler = " ".join(f"{lang}{chr(97 + i * k % 23)}{chr(97 + i * k % 19)}" for k in range(1, 12))
        rows.append((i, f"{filler} vile{lang} {filler}" if toxic else filler, lang))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs, lab, sample=100)
    got = score_toxicity(docs, model).join(lab, "doc_id").filter("lang = 'xx'").collect()
    assert all((r["severity"] >= 0.5) == (r["toxic"] == 1) for r in got) and sum(r["toxic"] for r in got) == 50


def test_strata_share_the_sample():
    from seekframe.llm.toxicity import _level
    assert _level([5], 10) == 5 and _level([100], 10) == 10 and _level([2, 100, 100], 20) == 9 and _level([3, 3, 3], 100) == 3


def test_toxicity_is_the_same_in_any_order(spark, small):
    docs, labels = small
    again = docs.unionByName(docs.filter("doc_id < 40")).orderBy(F.rand(3)).repartition(3)
    a, b = fit_toxicity(docs, labels), fit_toxicity(again, labels)
    assert a.vocabulary == b.vocabulary and abs(a.weights - b.weights).max() < 1e-9


def test_toxicity_odd_rows(odd, labels, no_labels, none):
    got = toxicity_digest(odd, labels).collect()
    assert len(got) == 11
    assert all(r["grade"] == 0 for r in got if r["doc_id"] in (1, 2, 7))
    assert toxicity_digest(odd, no_labels).filter("toxic").count() == 0
    assert toxicity_digest(none, no_labels).count() == 0
    assert reject_toxic(odd, fit_toxicity(odd, no_labels)).columns == odd.columns


def test_licences_odd_rows_against_sql(spark, odd, none):
    more = spark.createDataFrame([
        (20, "CC\nBY and cc-by, General\tPublic  License. ALL rights reserved all RIGHTS reserved"),
        (21, "Licensed under the Apache License, Version 2.0 (the License)"),
        (22, "licensed under the apache"), (25, "Licensed under the Apache\n# License, Version\n# 2.0" + " far" * 90 + " under the MIT license"),
        (26, "licensed under the GNU Affero General Public\nLicense, version 3" + " x" * 50 + " licensed under the GNU General Public License version 3"), (23, "cc cc by by"), (24, "Åcc by")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(more)
    got = licenses_digest(docs)
    con = duckdb.connect()
    frame = docs.toPandas()
    con.register("frame", frame)
    con.sql("create view documents as select doc_id::bigint as doc_id, text from frame")
    want = con.sql(licenses_sql())
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert want.columns == cols
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select(*cols).collect()), key=key) == sorted(want.fetchall(), key=key)
    by = {r["doc_id"]: r for r in got.filter("doc_id >= 20").collect()}
    assert by[20]["base_labels"] == "cc-by,gpl,reserved" and by[20]["n_base"] == 4
    assert by[25]["labels"] == "apache-2.0,mit" and by[26]["labels"] == "agpl-3.0,gpl,gpl-3.0"
    assert by[21]["labels"] == "apache-2.0" and by[22]["labels"] == "" and by[23]["n_base"] == 1
    assert licenses_digest(none).count() == 0


def test_licence_filters_lose_no_pair(spark):
    import random
    rng = random.Random(5)
    templates = {f"t{k}": " ".join(rng.sample([f"w{i}" for i in range(30)], rng.randint(3, 12))) for k in range(8)}
    lines = [" ".join(rng.choices([f"w{i}" for i in range(30)] + ["other"], k=rng.randint(1, 40))) for _ in range(400)]
    docs = spark.createDataFrame([(i, "\n".join(lines[i * 4:i * 4 + 4])) for i in range(100)], "doc_id long, text string")
    _, matches = scan_licenses(docs, templates=templates, short_forms={}, threshold=0.7)
    got = {(r["doc_id"], r["label"]) for r in matches.collect()}
    want = {(r["doc_id"], label) for r in docs.collect() for label in licence_labels(r["text"], templates, 0.7)}
    assert got == want and 100 < len(want) < 800


def test_notices_that_wrap_and_short_forms(spark, odd, none):
    import textwrap
    filler = "some other words of the same text go on and on " * 9
    rows = []
    for n, (label, t) in enumerate(sorted(TEMPLATES.items())):
        for width in (12, 40, 80):
            rows.append((len(rows), label, filler * (n % 3) + "\n * " + "\n * ".join(textwrap.wrap(t, width)) + "\n" + filler))
    rows += [(len(rows), "mit", "Released under the MIT License."), (len(rows) + 1, "", "released under the license of MIT"),
             (len(rows) + 2, "", ("hereby " + filler).join(["permission is", "granted free of charge", "to any person obtaining",
                                                              "a copy of this software", "and associated documentation files"]))]
    docs = spark.createDataFrame(rows, "doc_id long, want string, text string")
    got = {r["doc_id"]: set(r["labels"].split(",")) for r in licenses_digest(docs).collect()}
    assert all(want in got[i] for i, want, _ in rows)
    assert got[rows[-3][0]] == {"mit"}
    assert licenses_digest(odd).count() == 11 and licenses_digest(none).count() == 0


def test_notices_tell_gnu_licences_apart(spark):
    line = "This work is licensed under the GNU {}General Public License, version 3."
    gpl, agpl, lgpl = (line.format(x) for x in ("", "Affero ", "Lesser "))
    far = "\n" + "far away from it " * 60 + "\n"
    rows = [(1, gpl, "gpl-3.0"), (2, agpl, "agpl-3.0"), (3, lgpl.replace(" GNU", "\nGNU"), "lgpl-3.0"),
            (4, gpl + "\n" + agpl, "agpl-3.0,gpl-3.0"), (5, lgpl + far + gpl, "gpl-3.0,lgpl-3.0"),
            (6, gpl + "\nLicensed under the Apache License, Version 2.0", "apache-2.0,gpl-3.0")]
    got = licenses_digest(spark.createDataFrame(rows, "doc_id long, text string, want string"))
    # gpl is the label of the phrase, beside those of the templates
    assert {r["doc_id"]: ",".join(x for x in r["labels"].split(",") if x != "gpl") for r in got.collect()} \
        == {i: want for i, _, want in rows}


def test_secrets_base_against_brute_force(small, odd):
    docs = small[0]
    for frame in (docs, odd):
        got = sorted((r["doc_id"] or -1, r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"])
                     for r in secrets_digest(frame).collect())
        assert got == sorted((r["doc_id"] or -1, *base_secrets(r["text"])) for r in frame.select("doc_id", "text").collect())


def test_weak_parts_need_a_complement(spark, none):
    blob = "Ab3" * 12
    far = " x" * 400
    rows = [(1, f"user: alice {blob}"), (2, f"{blob} alone"), (3, f"user: alice {far} {blob}"),
            (4, "password=hunter22 at https://db.example/x"), (5, "see https://db.example/x"), (6, "secret: ab"),
            (7, "AKIA" + "A" * 12), (8, "AKIA" + "A" * 16 + f" {blob}"), (8, f"{blob} alone")]
    got = {(r["doc_id"], r["spans"]) for r in secrets_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    by = dict(got)
    assert by[1] == f"login:0:11,blob:12:{12 + 36}" and by[2] == "" and by[3] == ""
    assert by[4] == "assign:0:17,endpoint:21:41" and by[5] == "" and by[6] == "" and by[7] == ""
    assert (8, "access:0:20,blob:21:57") in got and (8, "") in got       # one id, two texts
    assert scan_secrets(none).count() == 0


def test_linked_parts_against_brute_force(spark):
    import random

    from seekframe.llm.secrets import COMPLEMENT, KINDS, strong_parts, weak_parts
    rng = random.Random(12)
    bits = ["user: alice", "login=bob99", "Ab3" * 12, "Zz9" * 14, "https://db.example/x", "10.0.0.1:80", "password=hunter22",
            "AKIA" + "B" * 16, "0123456789abcdef" * 2, "secret: ab"]
    texts = ["".join(rng.choice(bits) + " x" * rng.choice([1, 20, 90, 99, 100, 101, 250]) + " " for _ in range(rng.randint(0, 12)))
             for _ in range(80)]
    texts[0] = (bits[0] + " y" * 4000 + " " + bits[2]) * 3                    # parts far apart in a long text
    # gaps of exactly the scope, one more and one less, on and beside the borders of bins
    texts += [" " * (before - 11) + "user: alice" + " " * gap + "Ab3" * 12 for before in (199, 200, 201) for gap in (199, 200, 201)]
    texts += [" " * (before - 36) + "Ab3" * 12 + " " * gap + "user: alice" for before in (199, 200, 201) for gap in (199, 200, 201)]
    got = {r["doc_id"]: {tuple(p) for p in r["linked"]} for r in
           scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), scope=200).collect()}
    for i, t in enumerate(texts):
        weak, every = weak_parts(t), strong_parts(t) + weak_parts(t)
        want = {(s, k, e) for s, k, e in weak
                if any(KINDS[ok] in COMPLEMENT[KINDS[k]] and os - e <= 200 and s - oe <= 200 for os, ok, oe in every)}
        assert got[i] == want
    assert sum(map(len, got.values())) > 90
