"""The pipeline's stages, one after the other, against brute force on what each gets."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from feedstat.llm import line_dedup
from feedstat.session import materialize
from test_models import counted
from test_tokens import check_packing

STAGES = dict(corpus_pipeline.STAGES)
#: Names that operators use for columns of their own.
CLASHES = ["kept_text", "n_dropped", "n_lines", "_kept", "_id", "_mark", "kept", "n_removed", "n_words", "ids", "score", "row", "host", "mark", "carried"]
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACES.split(text or "") if w]


def corpus():
    rng = random.Random(6)

    def prose(n):
        return " ".join(rng.choice(["ka", "lo", "mi", "tu", "re", "so", "pe"]) + str(rng.randrange(400)) for _ in range(n))

    passage = prose(40)
    rows = [(k, "site a", f"{prose(30)}\nmenu of the site\n{prose(20)}") for k in range(20)]
    rows += [(100 + k, None, prose(25) + " " + passage + " " + prose(25)) for k in range(6)]
    copy = prose(120)
    rows += [(200 + k, "site b", copy.replace(copy.split()[3], f"word{k}")) for k in range(5)]
    rows += [(300, "site b", None), (301, "site b", ""), (302, None, "too short"), (303, "site b", "again and again " * 40)]
    rows += [(None, "site a", prose(60)), (None, "site b", prose(60)), (7, "site b", prose(50))] + rows[:2] + [(400, "site c", prose(3000))]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    own = [(k, text, "en", source, len(text or ""), *CLASHES) for k, source, text in rows]
    return spark.createDataFrame(
        own, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{name} string" for name in CLASHES)
    )


def rows_of(df):
    return [(r.doc_id, r.source, r.text) for r in df.collect()]


def without_boilerplate(rows):
    pages = Counter(source for _, source, _ in rows)
    on = Counter((source, line) for _, source, text in rows for line in set((text or "").split("\n")) if words(line))
    out = []
    for k, source, text in rows:
        lines = (text or "").split("\n")
        hot = {line for line in lines if on[source, line] >= line_dedup.MIN_PAGES and on[source, line] > line_dedup.RATIO * pages[source]}
        kept = [line for line in lines if line not in hot]
        out.append((k, source, "\n".join(kept if any(words(line) for line in kept) else lines)))
    return Counter(out)


def classes(rows):
    """For each row the rows in its class of near duplicates."""
    sets = []
    for _, _, text in rows:
        own = words(text)
        sets.append({tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                group = [group[a] if g == group[b] else g for g in group]
    found = {}
    for k, g in enumerate(group):
        found.setdefault(g, []).append(rows[k])
    return list(found.values())


def without_passages(rows):
    first = {}
    for k, _, text in rows:
        own = words(text)
        for i in range(len(own) - 12):
            window = tuple(own[i : i + 13])
            rank = float("inf") if k is None else k
            first[window] = min(first.get(window, rank), rank)
    out = []
    for k, source, text in rows:
        own, rank = words(text), float("inf") if k is None else k
        gone = {i + j for i in range(len(own) - 12) if first[tuple(own[i : i + 13])] < rank for j in range(13)}
        out.append((k, source, " ".join(w for i, w in enumerate(own) if i not in gone)))
    return Counter(out)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage got and gave; there are no labels, so the base rules alone judge."""
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, out = frame(spark, corpus()), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs, materialize(stage(spark, docs, folder), "stage")
        docs = out[name][1]
    return folder, out


def test_columns_come_through_all_stages(stages):
    docs = None
    for name, (before, after) in stages[1].items():
        if name != "packing":
            assert after.schema == before.schema
            docs = after
    row = docs.first()
    assert [row[name] for name in CLASHES] == CLASHES and all(r.n_chars == len(r.text or "") for r in docs.collect())


def test_rules_by_brute_force(stages):
    before, after = stages[1]["quality rules"]
    assert Counter(rows_of(after)) == Counter(row for row in rows_of(before) if not counted(row[2])[-1])


def test_lines_by_brute_force(stages):
    before, after = stages[1]["line dedup"]
    assert Counter(rows_of(after)) == without_boilerplate(rows_of(before))
    assert not any("menu of the site" in (text or "") for _, _, text in rows_of(after))


def test_near_duplicates_by_brute_force(stages):
    before, after = stages[1]["near duplicates"]
    left = Counter(rows_of(after))
    for members in classes(rows_of(before)):
        ids = [k for k, _, _ in members if k is not None]
        kept = [row for row in set(members) for _ in range(left.pop(row, 0))]
        assert len(kept) == 1 and kept[0][0] == (min(ids) if ids else None)
    assert not left


def test_passages_by_brute_force(stages):
    before, after = stages[1]["substring dedup"]
    assert Counter(rows_of(after)) == without_passages(rows_of(before))


def test_packing_by_the_tokenizer(stages):
    before, after = stages[1]["packing"]
    known = [row for row in before.select("doc_id", "text").collect()]
    ids = [row.doc_id for row in known]
    assert len(known) == after.where("piece = 0").count()
    once = {row.doc_id: row.text for row in known if ids.count(row.doc_id) == 1}
    check_sequences = {}
    for r in after.collect():
        check_sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in check_sequences.values():
        assert [a for a, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
    if len(once) == len(known):
        check_packing(after.collect(), once)


def test_empty_table(spark, stages):
    docs = frame(spark, corpus()).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, stages[0]), "stage")
        assert docs.count() == 0
