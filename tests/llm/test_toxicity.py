import numpy as np
import pyarrow as pa
import pytest

from lodewerk.llm import textarrays as ta
from lodewerk.llm import toxicity as t


def scored(*texts):
    return t._scores(pa.array(list(texts), pa.string()))[0].round(6).tolist()


@pytest.mark.parametrize(
    ("text", "score"),
    [
        ("You are an idiot.", 2.0),
        ("What an IDIOT!", 1.0),
        ("idiot### of%%% the", 1.0),
        ("You are not an idiot.", 0.0),
        ("He is not here, you idiot.", 2.0),
        ("The paper said that an idiot did it.", 0.1),
        ("An idiot, she said.", 0.2),
        ("I will kill you.", 3.0),
        ("I will not kill you.", 0.0),
        ("Go kill yourself", 3.0),
        ("This will kill time.", 0.0),
        ("The clown came.", 0.5),
        ("We read. idiot\nmoron", 2.0),
        ("Idiotentest und clownfish", 0.0),
        ("", 0.0),
    ],
)
def test_clauses(text, score):
    assert scored(text) == [score]


def naive(symbols):
    """All paths of the uncomposed parts, one word at a time."""
    paths = [((), symbols)]
    for part in (t.negation(), t.threats(), t.reported(), t.target()):
        grown = []
        for _, line in paths:
            for start in part.starts:
                state, out = start, []
                for s in line:
                    arcs = part.arcs.get(state, {}).get(s, [])
                    if not arcs:
                        break
                    o, _, state = arcs[0]
                    out.append(o)
                else:
                    if state in part.finals:
                        grown.append(((), "".join(out)))
        paths = grown
    return max((sum(t.WEIGHTS.get(s, 0.0) for s in line) for _, line in paths), default=-np.inf)


def test_composition_equals_the_parts_one_by_one():
    rng = np.random.default_rng(0)
    for _ in range(300):
        line = "".join(rng.choice(list("oiavtfmns"), rng.integers(1, 9)))
        symbols = np.array([t.SYMBOLS.index(s) for s in line])
        assert t.GRAMMAR.score(symbols, np.array([0]), np.array([len(line)]))[0] == pytest.approx(naive(line))


def test_cases(spark):
    rows = [(1, "you idiot", "a"), (2, None, "b"), (3, "", "c"), (None, "you idiot", "d"), (1, "you idiot", "a"), (4, "fine " * 200_000 + "moron", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    found = sorted((r.doc_id or 0, r.score) for r in t.score(docs).collect())
    assert found == [(0, 2.0), (1, 2.0), (1, 2.0), (2, 0.0), (3, 0.0), (4, 1.0)]
    assert sorted(r.doc_id for r in t.reject(docs).collect()) == [2, 3]
    assert t.reject(docs).columns == docs.columns
    assert t.score(docs.limit(0)).count() == 0 == t.reject(docs.limit(0)).count()


def test_labels(spark):
    """Every document with an insult is found, no clean one, on held labels of English documents."""
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.01/"
    docs = spark.read.parquet(d + "documents.parquet").filter("lang = 'en'")
    got = t.score(docs).join(spark.read.parquet(d + "labels.parquet"), "doc_id").groupBy("toxic").agg(F.count("*").alias("n"), F.sum((F.col("score") >= t.THRESHOLD).cast("int")).alias("hit")).collect()
    by = {r.toxic: (r.n, r.hit) for r in got}
    assert by[0][1] == 0
    assert by[1][1] >= 0.85 * by[1][0]


def test_words_reuse_the_lexicon():
    assert len(np.unique(t._HASHES)) == len(t._HASHES)
    assert ta.SPACE[32]


def test_stems_learned_from_labels_find_toxic_texts_of_every_language(spark):
    """Held out: learned on even ids, tried on odd ones, word by word as the table has them, in all languages."""
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.1/"
    docs, labels = spark.read.parquet(d + "documents.parquet"), spark.read.parquet(d + "labels.parquet")
    stems = t.learn(docs, labels.filter("doc_id % 2 = 0"))
    assert stems.texts and not set(stems.texts) & {w.encode() for x in t.LEXICON.values() for w in x.split()}
    got = t.score(docs, stems).join(labels.filter("doc_id % 2 = 1"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    by = {(r.lang, r.toxic): (r.n, r.hit) for r in got.groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum((F.col("score") >= t.THRESHOLD).cast("int")).alias("hit")).collect()}
    for lang in ("en", "de", "fr", "es"):
        assert by[lang, 1][1] >= 0.85 * by[lang, 1][0], by
        assert by[lang, 0][1] <= 0.02 * by[lang, 0][0], by


STEMS = t.Stems([b"zork", "blöm".encode()], np.array([6.0, 3.0]), np.array([0.02, 0.01]))


def by_stems(*texts):
    return t._scores(pa.array(list(texts), pa.string()), STEMS)[0].round(6).tolist()


def test_stems_weigh_like_a_word_by_word_count():
    """Against a plain count of the words that begin with a stem, in texts without clauses that change them."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        words = [str(rng.choice(["la", "zorkel", "zork", "blömchen", "mo", "bl"], p=[0.6, 0.03, 0.02, 0.05, 0.2, 0.1])) for _ in range(rng.integers(1, 80))]
        hits = [(6.0, 0.02) if w.startswith("zork") else (3.0, 0.01) for w in words if w.startswith(("zork", "blöm"))]
        want = max(0.0, sum(w for w, _ in hits) - len(words) * sum({r for _, r in hits})) * t.THRESHOLD / t.EVIDENCE
        assert by_stems(" ".join(words)) == [pytest.approx(want, abs=1e-5)]


def test_stems_go_through_the_grammar():
    plain, negated, said, aimed = by_stems("zorkel la", "not zorkel la", "she said zorkel la", "you zorkel la")
    assert negated == 0.0 and said < 0.2 * plain and aimed > plain > 0.4
    # one coincidence in a long text is what chance gives
    assert by_stems("zorkel " + "la " * 500) == [0.0]
    assert by_stems(None, "") == [0.0, 0.0]


def test_reports_do_not_add_up():
    assert scored("She said idiot. " * 50)[0] < t.THRESHOLD


def test_learn_cases(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (99, 1)], "doc_id bigint, toxic int")
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["gru" + "abcdefgh"[rng.integers(8)] * 3 if i % 2 and k % 9 == 0 else "w" + "".join(rng.choice(list("abcdefgh"), 5)) for k in range(60)])) for i in range(40)]
    docs = spark.createDataFrame([*rows, rows[1], (None, "gruaaa"), (5, None), (7, "")], "doc_id bigint, text string").withColumn("toxic", F_lit(1)).withColumn("stem", F_lit(2))
    stems = t.learn(docs, labels)
    assert any(s.startswith(b"gru") or b"gru".startswith(s) for s in stems.texts)
    assert t.learn(docs, labels.filter("toxic = 1")).texts == [] == t.learn(docs, labels.limit(0)).texts == t.learn(docs.limit(0), labels).texts
    # copies of one toxic text teach nothing
    copies = spark.createDataFrame([(2 * i + 1, "one toxic text with words of its own and some more of them") for i in range(20)] + [(2 * i, r[1]) for i, r in enumerate(rows[::2])], "doc_id bigint, text string")
    assert t.learn(copies, labels).texts == []


def F_lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)
