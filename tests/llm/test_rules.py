from __future__ import annotations

import math
import random
import re
from collections import Counter

import check
import samples

from replat.llm import quality_classifier, quality_rules, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(3)
    rows = samples.odd_rows() + [(100 + i, samples.prose(rng, rng.randrange(1, 60), 6)) for i in range(60)]
    rows += [(200, "a# b* c$ % & | < > \n\n x \n x \n x"), (201, "a a a a a"), (202, "a a a a a a"), (203, "É é ß\u00a0b", None)]
    out = quality_rules.quality_rules(samples.docs(spark, rows)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted((r["doc_id"] or -1, *(r[f] for f in fields)) for r in out)
    assert got == sorted((r[0] or -1, *base_of(r[1])) for r in rows)
    assert not any(r["kept"] for r in out if r["base_failed"])
    assert quality_rules.quality_rules(samples.docs(spark, [])).count() == 0


def test_texts_unlike_their_language_go(spark):
    rng = random.Random(4)
    words = quality_rules.COMMON_WORDS["en"]
    good = [" ".join(rng.choice(words) if rng.random() < 0.4 else "".join(rng.choices("abcdefgh", k=6)) for _ in range(120)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(good)]
    rows += [(100, good[0].upper()), (101, " ".join(w + "$$%" for w in good[1].split())), (102, " ".join(f"x{i}q" for i in range(120)))]
    rows += [(103, " ".join(f"X{i}" for i in range(20))), (104, " ".join(f"y{i}q" for i in range(120)), None)]
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(samples.docs(spark, rows)).collect()}
    assert all(out[i]["kept"] for i in range(30))
    assert [out[i]["kept"] for i in (100, 101, 102)] == [False] * 3
    assert out[103]["kept"] and out[104]["kept"]  # too short to be compared; the only text of its language


def test_distance_is_jensen_shannon(spark):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.2, 0.7]
    df = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
    mean = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = [sum(a * math.log2(a / m) for a, m in zip(x, mean, strict=True) if a) for x in (p, q)]
    got = df.select(quality_rules.distance(df["p"], df["q"]).alias("d")).first()["d"]
    assert math.isclose(got, math.sqrt(sum(kl) / 2))


def test_rules_run_without_python(spark):
    plan = quality_rules.quality_rules(samples.docs(spark, [(1, "a b")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "https://www.example.com/en/", "https://example.com/en/1?q=casino",
    "https://a.example.com/EN/1", "https://notexample.com/en/", "http://a.net/es/", "http://net/fr/x#y", "http://x.net/es", "http://x.org/casino/",
    "http://x.org/casinos", "http://x.org/a.exe?b", "http://x.org/exe", "http://x.org/wp-login.php", "x://y://z.net/fr/", "http://é.net/es/\n#",
    "http://u:p@example.com:80/en/", "http://a.com",
]


def test_urls_equal_sql_and_every_rule_tried(spark):
    df = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    df = df.union(df.limit(3))
    out = url_rules.judged_urls(df)
    con = check.duckdb.connect()
    con.register("pages_df", df.toPandas())
    con.sql("create view pages as select * from pages_df")
    rel = con.sql(url_rules.oracle())
    assert check.as_bag(out.columns, out.collect()) == check.as_bag(rel.columns, rel.fetchall())
    assert url_rules.judged_urls(df.limit(0)).count() == 0


def test_rules_are_found_by_their_rarest_token():
    rules = [url_rules.place_rule("block", "example.com/en/"), url_rules.word_rule("casino"), url_rules.Rule("block", "q+", ())]
    index, always = url_rules.rule_index(rules, {"example": 9, "com": 50, "en": 3, "casino": 1})
    assert {t: [r.pattern for r in rs] for t, rs in index.items()} == {"en": [rules[0].pattern], "casino": [rules[1].pattern]}
    assert always == [rules[2]]
    for rule in (*url_rules.PLACES, *url_rules.PATTERNS):
        for url in filter(None, URLS):
            low = url.lower()
            parts = url_rules.HOST.search(url)
            target = parts[1].lower() + parts[2] if parts and rule.place else low
            if (re.match if rule.place else re.search)(rule.pattern, target):
                assert set(rule.tokens) <= set(re.findall(url_rules.TOKEN, low))


def labelled(spark, n=400):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = samples.prose(rng, rng.randrange(20, 120), 900)
        rows.append((i, " ".join(w.upper() + "!!" for w in text.split()) if bad else text))
        labels.append((i, 0 if bad else 1, 0))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    out = quality_classifier.quality_scores(samples.docs(spark, rows + samples.odd_rows()[:4]), labels).collect()
    import zlib

    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    tested = [r for r in out if r["held_out"] and r["doc_id"] in truth and len(dict(rows).get(r["doc_id"]) or "") > 40]
    assert len(tested) > 50
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) >= 0.95 * len(tested)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out)
    shuffled = quality_classifier.quality_scores(samples.docs(spark, (rows + samples.odd_rows()[:4])[::-1], 7), labels.repartition(5)).collect()
    again = {r["doc_id"]: r["score"] for r in shuffled}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-12 for r in tested)


def test_classifier_does_not_learn_from_held_out_rows(spark):
    from pyspark.sql import functions as F

    rows, labels = labelled(spark)
    flipped = labels.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (
        {r["doc_id"]: r["score"] for r in quality_classifier.quality_scores(samples.docs(spark, rows), x).collect()} for x in (labels, flipped)
    )
    assert one == two


def test_classifier_without_labels_and_without_rows(spark):
    none = spark.createDataFrame([(None, None, None), (1, 5, 0)], "doc_id long, quality int, toxic int")
    out = quality_classifier.quality_scores(samples.docs(spark, samples.odd_rows()), none).collect()
    assert len(out) == len(samples.odd_rows()) and {r["score"] for r in out} == {0.5}
    assert quality_classifier.quality_scores(samples.docs(spark, []), none).count() == 0


def test_calibration_has_both_classes_when_the_bounds_bind(spark):
    """With fewer rows allowed than there are, dictionaries must not use up a class."""
    rows, labels = labelled(spark)
    fit = quality_classifier.Fit(per_class=25, calibration=60, dictionary=20_000)
    chosen = quality_classifier.sample(quality_classifier.keyed_text(samples.docs(spark, rows)), labels, fit)
    assert len(chosen) <= 110
    model = quality_classifier.trained(chosen, fit)
    assert model.constant is None
    out = {r["row"]["doc_id"]: r["score"] for r in quality_classifier.scored(samples.docs(spark, rows), model).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert sum((out[k] >= 0.7) == (q == 1) for k, q in truth.items()) >= 0.95 * len(truth)


def test_classifier_scores_long_texts_repeated_rows_and_rows_without_keys(spark):
    rows, labels = labelled(spark)
    long = "\n".join(t for _, t in rows if t) * 3
    long = (long * (70_000 // len(long) + 1))[:90_000]
    odd = [(None, rows[0][1]), (None, None), (9_000_001, long), (9_000_001, long), (9_000_002, "")]
    known = labels.union(spark.createDataFrame([(9_000_001, 0, 0)], labels.schema))
    fit = quality_classifier.Fit()
    docs = samples.docs(spark, rows + odd)
    chosen = quality_classifier.sample(quality_classifier.keyed_text(docs), known, fit)
    assert max(len(t) for t, _ in chosen) <= fit.longest < len(long) and len({t for t, _ in chosen}) == len(chosen)
    out = quality_classifier.quality_scores(docs, known).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    scores = {}
    for r in out:
        scores.setdefault(r["doc_id"], []).append(r["score"])
    assert scores[9_000_001][0] == scores[9_000_001][1] and scores[rows[0][0]][0] in scores[None]
    assert not any(r["held_out"] for r in out if r["doc_id"] is None)


def test_the_score_comes_from_size_differences(spark):
    """Every column but the constant lies between -1 and 1, and turns round when good and bad text change places."""
    model = quality_classifier.Model(((b"good words here " * 60, b"bad spam spam " * 60),), (), 1024, 3)
    other = quality_classifier.Model(tuple((b, g) for g, b in model.dictionaries), (), 1024, 3)
    texts = [b"good words here and good words there", b"spam spam bad spam", b"", b"good words " * 900]
    x, y = (quality_classifier.Sizes(m).features(texts) for m in (model, other))
    assert (abs(x[:, 1:]) <= 1).all() and (x[:, 2] == -y[:, 2]).all()
    assert x[0, 2] > 0 > x[1, 2]
