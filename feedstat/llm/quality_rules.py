"""Quality rules: base statistics of a text and a decision list learned from labels.

Everything is DataFrame and SQL functions. Sequential covering learns the list: a rule grows
by the condition (feature at least, or below, a threshold) of the largest information gain
on the growing rows, is cut back to the prefix that does best on the pruning rows, and, if it
is precise enough there, takes the rows it covers out. The driver sees only counts of labelled
rows per feature, threshold and label. The list becomes one ordered conditional expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from feedstat.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SHARES = [0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
LENGTHS = [2, 2.5, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 7.5, 8, 9, 10, 12, 15, 20]
#: The features that rules may use, with their thresholds.
FEATURES = {
    "symbols_per_word": [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1, 1.5, 2, 3],
    "marks_per_word": [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1, 1.5, 2, 3],
    "upper_share": SHARES,
    "mean_word": LENGTHS,
    "dup_line_share": SHARES,
    "repeat_share": SHARES,
    "distinct_share": SHARES,
}
MAX_RULES, MAX_CONDITIONS = 8, 3
MIN_PRECISION, MIN_COVERED = 0.9, 3


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a run of ``window`` words found twice or more in the array.

    Runs stand for themselves by two 64-bit hashes. Sorted with their places, equal runs are
    neighbours; sorted back by place, each adds the words up to the next repeated run.
    """
    return let(words, lambda own: _repeated_words(own, window))


def _repeated_words(words: Column, window: int) -> Column:
    count = F.size(words) - (window - 1)

    def run(place):
        own = F.slice(words, place + 1, window)
        return F.struct(F.xxhash64(own).alias("a"), F.xxhash64(F.lit(1), own).alias("b"), place.alias("place"))

    def same(x, y):
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    def places(runs):
        twice = F.filter(runs, lambda x, k: (
            same(x, F.get(runs, k - 1)) | same(x, F.get(runs, k + 1))
        ))
        return F.array_sort(F.transform(twice, lambda x: x["place"]))

    def covered(found):
        return F.aggregate(
            F.transform(found, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(found, k + 1) - x, F.lit(window)))),
            F.lit(0).cast("long"), lambda total, x: total + x,
        )

    def marks(runs):
        return let(F.transform(runs, lambda x: x["a"]), lambda keys: F.size(F.array_distinct(keys)) < F.size(keys))

    runs = F.transform(F.sequence(F.lit(0), count - 1), run)
    return F.when(count < 2, F.lit(0).cast("long")).otherwise(
        let(runs, lambda own: F.when(
            marks(own), let(F.sort_array(own), lambda ordered: let(places(ordered), covered))
        ).otherwise(F.lit(0).cast("long")))
    )


def base_statistics(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Counts and features of every row's whole text; a null text has no words and one empty line.

    Columns of ``carry`` come along in ``carried``. A condition on the result has to name ``row``
    too: its number can't be moved, which keeps Catalyst from putting the statistics themselves
    into the condition, once for each time it names them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), (F.struct(*carry) if carry else F.lit(0)).alias("carried"))
    trimmed = F.btrim(F.col("text"), F.lit(SPACE_CHARS))
    split = plain.select(
        "doc_id", "text", "carried",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "").alias("lines"),
    )
    counts = split.select(
        "doc_id", "carried", F.monotonically_increasing_id().alias("row"),
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - removed(F.col("text"), SPACE_CHARS)).cast("long").alias("word_chars"),
        removed(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        removed(F.col("text"), "!?").alias("n_marks"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))).alias("n_upper"),
    )
    words, lines = F.greatest(F.lit(1), F.col("n_words")), F.greatest(F.lit(1), F.col("n_lines"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_marks") / words).alias("marks_per_word"),
        (F.col("n_upper") / F.greatest(F.lit(1), F.col("word_chars"))).alias("upper_share"),
        (F.col("word_chars") / words).alias("mean_word"),
        (F.col("n_dup_lines") / lines).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("n_distinct") / words).alias("distinct_share"),
        *(["row", "carried"] if carry else []),
    )


Condition = tuple[str, str, float]


def holds(conditions: list[Condition]) -> Column:
    """All conditions of a rule as a Spark expression."""
    result = F.lit(True)
    for name, side, threshold in conditions:
        test = F.col(name) >= threshold if side == ">=" else F.col(name) < threshold
        result = result & test
    return result


def _cells(rows: DataFrame) -> dict[str, dict[float, list[int]]]:
    """For each feature and threshold, labelled rows at or above it: [good, poor]; and all under -inf."""
    def steps(name):
        return sum((F.col(name) >= float(t)).cast("int") for t in FEATURES[name])

    names = list(FEATURES)
    places = [F.struct(F.lit(name).alias("feature"), steps(name).alias("step")) for name in names]
    counted = (
        rows.select("poor", F.explode(F.array(*places)).alias("at"))
        .groupBy("at.feature", "at.step", "poor").count().collect()
    )
    result = {name: {t: [0, 0] for t in [-math.inf, *FEATURES[name]]} for name in names}
    for feature, step, poor, n in counted:
        for threshold in [-math.inf, *FEATURES[feature]][: step + 1]:
            result[feature][threshold][poor] += n
    return result


def _grow(rows: DataFrame) -> list[Condition]:
    conditions: list[Condition] = []
    while len(conditions) < MAX_CONDITIONS:
        cells = _cells(rows.where(holds(conditions)))
        good, poor = next(iter(cells.values()))[-math.inf]
        if not poor or not good:
            break
        now, best = math.log2(poor / (good + poor)), (0.0, None)
        for name, by in cells.items():
            for threshold in FEATURES[name]:
                above = by[threshold]
                for side, (n, p) in ((">=", above), ("<", [good - above[0], poor - above[1]])):
                    if p >= MIN_COVERED and (gain := p * (math.log2(p / (p + n)) - now)) > best[0] + 1e-9:
                        best = gain, (name, side, float(threshold))
        if best[1] is None:
            break
        conditions.append(best[1])
    return conditions


def _prune(rows: DataFrame, conditions: list[Condition]) -> tuple[list[Condition], int, int]:
    """The prefix of the best (poor - good) / covered on ``rows``, and how many of each it covers."""
    sums = [
        F.coalesce(F.sum(F.when(holds(conditions[:k]) & (F.col("poor") == value), 1).otherwise(0)), F.lit(0))
        for k in range(1, len(conditions) + 1) for value in (1, 0)
    ]
    found = rows.agg(*[s.alias(f"c{k}") for k, s in enumerate(sums)]).first()
    best = max(
        range(len(conditions)),
        key=lambda k: ((found[2 * k] - found[2 * k + 1]) / max(1, found[2 * k] + found[2 * k + 1]), -k),
    )
    return conditions[: best + 1], found[2 * best], found[2 * best + 1]


def learn_rules(statistics: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """An ordered list of rules, each for poor texts, from all labelled rows that pass the base rules.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 poor); rows with a null label are left
    out. A third of the rows, by hash of the id, prunes. Without poor or good rows, and where no
    rule is precise enough on the pruning rows, the list ends.
    """
    marked = labels.where("quality IS NOT NULL").select(
        F.col("doc_id"), (F.col("quality") == 0).cast("int").alias("poor")
    )
    rows = materialize(
        statistics.where(~F.col("base_failed")).join(marked, "doc_id")
        .withColumn("pruning", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0),
        "labelled",
    )
    rules: list[list[Condition]] = []
    while len(rules) < MAX_RULES:
        grown = _grow(rows.where(~F.col("pruning")))
        if not grown:
            break
        rule, poor, good = _prune(rows.where("pruning"), grown)
        if poor + good == 0 or poor < MIN_PRECISION * (poor + good):
            break
        rules.append(rule)
        rows = rows.where(~holds(rule))
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one ordered expression: true for a text that no rule rejects."""
    result = F.when(F.col("base_failed"), False)
    for rule in rules:
        result = result.when(holds(rule), False)
    return result.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base statistics and ``kept`` of every row of ``docs``.

    Null and empty texts have no words and fail the base rules. Repeated rows are judged one by
    one; other columns are not read. An empty table, or one without labels, is judged by the
    base rules alone.
    """
    statistics = materialize(base_statistics(docs, id_col, text_col), "text-statistics")
    judged = statistics.withColumn("kept", verdict(learn_rules(statistics, labels)))
    return judged.withColumnRenamed("doc_id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    Rows are written once with their statistics, to learn and then to decide, so texts are
    neither read through twice nor shuffled.
    """
    statistics = materialize(base_statistics(docs, id_col, text_col, docs.columns), "text-statistics")
    rules = learn_rules(statistics.drop("row", "carried"), labels)
    return statistics.where(verdict(rules)).select(*[F.col("carried").getField(name).alias(name) for name in docs.columns])


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base statistics and the learned verdict for every document."""
    return judge(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {"op5_quality_rules": op5_quality_rules}
