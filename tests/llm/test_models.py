"""Rules and classifiers: counts by brute force, held-out labels, odd rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedstat.llm import ngram_join, quality_model, quality_rules, substring_dedup, toxicity
from feedstat.session import materialize

LARGER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (0, None), (1, ""), (2, " \n\n"), (3, "one two"), (4, "a b c d e f g h " * 5), (5, "a b c d e f g h a b c d e f g h"),
    (6, "x\nx\n\n\ny\n x"), (7, "## $$ | <a> & * %"), (8, "w " * 3000), (9, "word glued\x1cwords " * 30), (9, "word"), (None, "null id"),
]


def counted(text):
    words = WORD.findall(text or "")
    runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    places = {k + j for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for j in range(8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 20 or 100 * len(places) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(places), failed


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()] + ODD
    docs = spark.createDataFrame([(k, text, 1, "") for k, text in rows], "doc_id long, text string, n_words int, words string")
    got = Counter(tuple(r) for r in quality_rules.base_statistics(docs).select("doc_id", *NAMES).collect())
    assert got == Counter((k, *counted(text)) for k, text in rows)


def test_rules_on_documents(spark):
    result = quality_rules.op5_quality_rules(spark, LARGER)
    assert "Python" not in result._jdf.queryExecution().toString()
    judged = result.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").where("NOT base_failed")
    table = {(r.kept, r.quality): r["count"] for r in judged.groupBy("kept", "quality").count().collect()}
    assert table[(True, 1)] >= 0.98 * (table[(True, 1)] + table.get((False, 1), 0))
    assert table.get((False, 0), 0) >= 0.7 * (table.get((False, 0), 0) + table.get((True, 0), 0))
    assert result.where("base_failed AND kept").count() == 0


def test_rules_find_a_planted_condition(spark):
    rows = [(k, " ".join(f"w{(k * 31 + j) % 997}" for j in range(30)) + (" $$$" * 12 if k % 4 == 0 else "")) for k in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 4 == 0, 0).otherwise(1).alias("quality"))
    kept = {r.doc_id: r.kept for r in quality_rules.judge(docs, labels).collect()}
    assert kept == {k: k % 4 != 0 for k, _ in rows}
    good = quality_rules.keep_good(docs.withColumn("row", F.lit(1)), labels)
    assert good.columns == ["doc_id", "text", "row"] and {r.doc_id for r in good.collect()} == {k for k in kept if kept[k]}
    for few in (labels.limit(0), labels.where("quality = 1"), labels.select("doc_id", F.lit(None).cast("int").alias("quality"))):
        assert quality_rules.judge(docs, few).where("kept").count() == len(rows)
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("module, name, label, most", [
    (quality_model, "op8_quality", "quality", 0.9), (toxicity, "op10_toxicity", "toxic", 0.75),
])
def test_held_out_labels(spark, module, name, label, most):
    result = materialize(module.QUERIES[name](spark, LARGER), "scored")
    assert result.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert result.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    held = result.where("held_out").join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id")
    rows = [(r.score, r[label]) for r in held.select("score", label).collect()]
    ones, zeros = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    ranked = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert ranked >= most


@pytest.mark.parametrize("module", [quality_model, toxicity])
def test_scores_of_odd_rows(spark, module):
    docs = spark.createDataFrame([(k, text, 1.0, "t") for k, text in ODD], "doc_id long, text string, label double, features string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(3, 9)] + [(1, None)], "doc_id long, label int")
    for few in (labels, labels.limit(0), labels.where("label = 1")):
        scored = quality_model.score(docs, module.fit(docs, few))
        assert scored.columns == ["doc_id", "label", "features", "score"]
        assert scored.where("score BETWEEN 0 AND 1").count() == len(ODD)
    assert quality_model.score(docs.limit(0), module.fit(docs, labels)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_automaton_equals_edit_distance():
    import random

    own = random.Random(8)
    terms = {"".join(own.choice("abc") for _ in range(n)): 6.0 for n in (3, 4, 5, 6, 8, 9)}
    automaton = toxicity.LexiconAutomaton(terms, {"cab": 3.0})
    for _ in range(3000):
        word = "".join(own.choice("abcd") for _ in range(own.randint(1, 11)))
        if own.random() < 0.5:
            word = list(own.choice(list(terms)))
            for _ in range(own.randint(0, 3)):
                word[own.randrange(len(word))] = own.choice("abd")
            word = "".join(word)
        exact = [6.0 for t in terms if t == word] + [3.0 for s in ("cab",) if word.startswith(s)]
        near = [toxicity.NEAR_LONG_ODDS if len(t) >= 6 else toxicity.NEAR_SHORT_ODDS for t in terms
                if 0 < distance(t, word) <= toxicity.edits_allowed(t)]
        assert automaton.match(word)[0] == max(exact + near, default=0.0), word


@pytest.mark.parametrize("scale, most", [("sf0.01", toxicity.TRAIN_ROWS), ("sf0.1", 60), ("sf0.1", toxicity.TRAIN_ROWS)])
def test_misspelled_terms_are_found_at_any_label_count(spark, scale, most):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"/root/testdata/{scale}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    held = quality_model.fold(F.col("doc_id"), 3) == 1
    lexicon = toxicity.fit(docs, labels.where(~held), most)
    rows = docs.join(labels.where(held & F.col("label").isNotNull()), "doc_id").collect()

    def changed(word):
        own = toxicity.plain(word)
        return word.lower().replace(own, own[:2] + "x" + own[3:]) if own in lexicon.terms and len(own) >= 4 else word

    def found(label, change):
        texts = [r.text or "" for r in rows if r.label == label]
        return (lexicon.scores([" ".join(map(change, t.split(" "))) for t in texts]) >= 0.7).mean()

    assert found(1, str) >= 0.7 and found(0, str) <= 0.05
    assert found(1, changed) >= 0.9 * found(1, str)


def test_context_tells_quotation_from_abuse():
    lexicon = toxicity.Lexicon({"scoundrel": 6.0}, {}, frozenset(), (6.0, 0.0), -4.0)
    plain, misspelled, quoted, reported, none = lexicon.scores(
        ["you utter scoundrel go", "you scoundrell go", 'the "scoundrel" in the play', "he wrote scoundrel once", "calm"]
    )
    assert plain > 0.7 and misspelled > 0.7 and max(quoted, reported, none) < 0.3


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against what its operator and brute force give."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        results.append(materialize(stage(spark, results[-1] if results else docs, LARGER), "stage"))
    good, lines, single, passages, packed = results
    assert all(df.columns == docs.columns for df in results[:4])
    verdicts = quality_rules.op5_quality_rules(spark, LARGER).where("kept").select("doc_id")
    assert Counter(good.select("doc_id").collect()) == Counter(verdicts.collect())
    assert lines.count() == good.count() and lines.where("n_chars <> length(text)").count() == 0
    assert single.count() == ngram_join.near_duplicates(lines).select("class_id").distinct().count()
    assert ngram_join.near_duplicates(single).where("n_links > 0").count() == 0
    expected = substring_dedup.drop_passages(single).select("doc_id", "kept").collect()
    assert Counter(map(tuple, expected)) == Counter(map(tuple, passages.select("doc_id", "text").collect()))
    assert packed.select("doc_id").distinct().count() == passages.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).where("n > 1024 OR n <> end").count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
