import re

import corpus_pipeline
import pandas as pd

from lodewerk.llm import decontaminate, suffixdedup, toxicity

D = "/root/testdata/sf0.001"


def windows_of(text, n):
    w = text.split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_stages_and_run_agree_with_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    kept, columns = {}, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, D)
        if name != "packing":
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.toPandas()
    raw = pd.read_parquet(f"{D}/documents.parquet")
    # the grammar's words without any grammar: a document without one stays, one with a plain insult goes
    insults = re.compile(r"(?<![a-zà-ÿ])(?:" + "|".join(toxicity.LEXICON[toxicity.INSULT].split()) + r")(?![a-zà-ÿ])", re.I)
    hit = raw.text.map(lambda t: bool(insults.search(t)))
    assert set(kept["toxicity"].doc_id) == set(raw.doc_id[~hit])
    # exact copies have gone
    assert not kept["minhash_near_dedup"].text.duplicated().any()
    # no window of 50 words is left twice but in one that earlier cuts made anew
    before, after = (kept[n] for n in ("minhash_near_dedup", "suffix_array_dedup"))
    old = set().union(*(windows_of(t, suffixdedup.MIN_WORDS) for t in before.text))
    seen = set()
    for t in after.sort_values("doc_id").text:
        mine = windows_of(t, suffixdedup.MIN_WORDS) & old
        assert not mine & seen
        seen |= mine
    assert (after.n_chars == after.text.str.len()).all()
    # documents with a run of benchmark words have gone, no others
    marks = set().union(*(windows_of(t, decontaminate.MIN_WORDS) for t in pd.read_parquet(f"{D}/benchmark.parquet").text))
    dirty = after.text.map(lambda t: bool(windows_of(t, decontaminate.MIN_WORDS) & marks))
    clean = kept["decontamination"]
    assert set(clean.doc_id) == set(after.doc_id[~dirty]) and dirty.any()
    places = sorted((r.doc_id, w) for r in kept["packing"].itertuples() for w in range(r.first_word, r.first_word + r.words))
    assert places == sorted((i, w) for i, t in zip(clean.doc_id, clean.text, strict=True) for w in range(len(t.split())))
    again = corpus_pipeline.run(spark, D).toPandas()
    key = ["pack_id", "place"]
    assert again.sort_values(key).values.tolist() == kept["packing"].sort_values(key).values.tolist()


def test_cases(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows, columns with names used inside, and an empty table, through all stages."""
    from collections import Counter

    from pyspark.sql import functions as F

    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    leak = words("leak", 20)
    rows = [(1, words("a", 120)), (1, words("a", 120)), (2, words("a", 119) + " z"), (3, None), (None, words("n", 60)), (None, None), (4, ""), (5, ""), (6, words("l", 30_000)), (7, "see " + leak), (8, "you idiot"), (9, words("q", 60) + " x y"), (10, words("q", 60) + " " + words("r", 90)), (50, "one two"), (100, "one two three four")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("bigint"))
    docs = docs.withColumns({c: F.lit(1) for c in ("_id", "_mark", "_cut", "_extra", "mark", "words", "score", "group_id")})
    for name, table in (("documents", docs), ("empty", docs.limit(0))):
        d = f"{tmp_path}/{name}"
        table.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, leak), (2, None), (None, leak)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame([(1, 0), (8, 1), (None, 1)], "doc_id bigint, toxic int").write.parquet(f"{d}/labels.parquet")
    d = f"{tmp_path}/documents"
    kept, now = {}, docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, d)
        assert name == "packing" or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = Counter(r.doc_id for r in now.select("doc_id").collect())
    assert kept["toxicity"] == Counter(r[0] for r in rows) - Counter([8])
    assert kept["minhash_near_dedup"] == kept["toxicity"] - Counter([2, 5])
    assert kept["suffix_array_dedup"] == kept["minhash_near_dedup"]
    assert kept["decontamination"] == kept["suffix_array_dedup"] - Counter([7])
    packed = corpus_pipeline.run(spark, d).collect()
    size = Counter()
    for r in packed:
        size[r.doc_id] += r.words
    assert size == {1: 240, 6: 30_000, 9: 62, 10: 90, 50: 2, 100: 4}
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
