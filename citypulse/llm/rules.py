"""Quality rules with risk-controlled thresholds.

Every rule is a statistic of a text that is high for bad texts. Per stratum,
the labelled good documents bound the cutoffs of all rules together, by
statistically equivalent blocks (Wald, Tukey, Fraser): the rules in turn cut
away the good documents that are highest by them among those still left, and
each takes the value of the last one it cut away as its cutoff. However the rules
depend on each other, the share of good documents beyond any cutoff is then
at most Beta(a, n + 1 - a) for a of n documents cut away, ties making it less; so it
exceeds ``risk`` with the probability that a binomial (n, risk) is under a. The
largest a is taken for which this is at most the stratum's part of ``delta``.
It depends on n alone, so neither the grid nor the number of rules costs
confidence, and strata with too few documents to cut one away take no part of
``delta``. So with probability at least 1 - delta, no stratum loses more than
``risk`` of its good documents to the rules. With 1 % and 5 % a single stratum
needs 299 good documents for its first rule, one of four 437. Smaller ones
get no cutoff and lose nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citypulse.llm import common

SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: statistics in thousandths; each is bad when high
RULES = {
    "symbols": "1000 * n_symbols / greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines / greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words / greatest(n_words, 1)",
    "long_words": "1000 * word_chars / greatest(n_words, 1)",
    "upper": "1000 * n_upper / greatest(word_chars, 1)",
    "marks": "1000 * n_marks / greatest(n_words, 1)",
}
GRID = [5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900, 1000,
        1500, 2000, 3000, 4000, 5000, 6000, 7000, 8000, 10000, 12000, 15000, 20000, 30000, 50000]


def text_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each of many texts, given as bytes and row offsets."""
    start, end, first = common.words_of(data, offsets, common.NOT_BLANK)
    rows = len(offsets) - 1

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    hashes = common.word_hashes(data, start, end)
    row_of = np.repeat(np.arange(rows), np.diff(first))
    repeat = np.zeros(len(hashes), bool)
    if len(hashes) >= 8:
        whole = row_of[:len(hashes) - 7] == row_of[7:]
        at = np.flatnonzero(whole)
        window = common.mixed(common.run_hashes(hashes, 8)[at] + row_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        for i in range(8):
            repeat[at[twice] + i] = True

    # lines of a row that hold a word: hash of the bytes between line feeds
    cut = np.union1d(np.flatnonzero(data == 10), offsets[1:] - 1) if len(data) else np.empty(0, np.int64)
    line_start = np.concatenate(([0], cut[:-1] + 1)) if len(cut) else np.empty(0, np.int64)
    is_feed = data[cut] == 10 if len(cut) else np.empty(0, bool)
    line_end = cut + ~is_feed
    words_before = np.searchsorted(start, np.concatenate((line_start, [len(data)])))
    held = np.flatnonzero((line_end > line_start) & (np.diff(words_before) > 0))
    line_hash = common.word_hashes(data, line_start[held], line_end[held])
    line_row = np.searchsorted(offsets, line_start[held], side="right") - 1
    order = np.lexsort((held, line_hash, line_row))
    dup = np.zeros(len(held), bool)
    if len(held):
        dup[order[1:]] = (line_hash[order][1:] == line_hash[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    by_row = lambda rows_of, weight=None: np.bincount(rows_of, weight, rows).astype(np.int64)
    begins = (data & 0xC0) != 0x80  # one byte of each code point
    marks = np.isin(data, np.frombuffer(b"!?", np.uint8))
    return {
        "n_words": np.diff(first),
        "word_chars": per_row(begins & common.NOT_BLANK[data]),
        "n_symbols": per_row(_SYMBOL[data]),
        "n_dup_lines": by_row(line_row, dup),
        "n_repeat_words": by_row(row_of, repeat),
        "n_lines": by_row(line_row),
        "n_upper": per_row((data >= 65) & (data <= 90)),
        "n_marks": per_row(marks),
    }


STATS = [*COUNTS, "n_lines", "n_upper", "n_marks"]


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the counts as long columns to the given columns and drops the
    text. Null and empty texts have zero counts. Repeats within a text are
    found by 64-bit hashes of its windows and lines. Clashing columns of the
    input are replaced."""
    source = docs.drop(*[c for c in docs.columns if c.lower() in STATS and c != text_col])
    source = source.withColumn(text_col, common.text_of(text_col))
    kept = [c for c in source.columns if c != text_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != text_col]
                       + [f"{c} long" for c in STATS])

    def run(batches_in):
        for batch in batches_in:
            for part in common.by_bytes(batch, text_col):
                found = text_stats(*common.text_bytes(part.column(text_col)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(found[c], pa.int64()) for c in STATS],
                    names=kept + STATS)

    return common.map_arrow(source, run, schema)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed in logarithms."""
    if p <= 0 or k >= n:
        return 1.0
    if p >= 1:
        return 0.0
    i = np.arange(k + 1)
    steps = np.log((n - i[1:] + 1) / i[1:]) if k else np.empty(0)
    logs = np.concatenate(([0.0], np.cumsum(steps))) + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def upper_bound(k: int, n: int, alpha: float) -> float:
    """Clopper-Pearson: the largest rate p with P(X <= k | n, p) >= alpha."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_tail(k, n, mid) >= alpha else (low, mid)
    return high


def cutoffs(good: DataFrame, stratum: str = "stratum", risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """Per stratum and rule, each rule by itself with an equal share of the
    risk, the strictest cutoff of the grid that an exact (Clopper-Pearson) bound
    admits, corrected for all cutoffs, rules and strata (Bonferroni). It takes
    thousands of documents; ``joint_cutoffs`` is what ``judged`` uses. Columns stratum, rule, cutoff, n_good, n_rejected, bound. ``good`` has the rule columns
    of the labelled good documents. Counts by (stratum, rule, grid cell) are
    made by Spark; the bounds are computed on those few rows per stratum."""
    cells = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])
    grid = F.array(*[F.lit(g) for g in GRID])
    seen = (good.select(F.col(stratum).alias("stratum"), F.explode(cells).alias("c"))
            .select("stratum", "c.rule", F.size(F.filter(grid, lambda g: g < F.col("c.value"))).alias("cell"))
            .groupBy("stratum", "rule", "cell").agg(F.count(F.lit(1)).alias("n")))
    strata = max(1, good.select(stratum).distinct().count())
    alpha, share = delta / (strata * len(RULES) * len(GRID)), risk / len(RULES)

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(len(GRID) + 1, np.int64)
        np.add.at(counts, group["cell"].to_numpy(), group["n"].to_numpy())
        above = counts[::-1].cumsum()[::-1][1:]  # documents whose value exceeds GRID[i]
        n = int(counts.sum())
        for i, k in enumerate(above.tolist()):
            if k / n <= share and (bound := upper_bound(k, n, alpha)) <= share:
                return pd.DataFrame([(group["stratum"].iloc[0], group["rule"].iloc[0], GRID[i], n, k, bound)],
                                    columns=["stratum", "rule", "cutoff", "n_good", "n_rejected", "bound"])
        return pd.DataFrame(columns=["stratum", "rule", "cutoff", "n_good", "n_rejected", "bound"])

    return seen.groupBy("stratum", "rule").applyInPandas(
        choose, "stratum string, rule string, cutoff long, n_good long, n_rejected long, bound double")


def blocks_for(n: int, risk: float, alpha: float) -> int:
    """The most of ``n`` documents that may be cut away: the largest a with
    P(X < a | n, risk) <= alpha."""
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if binomial_tail(mid - 1, n, risk) <= alpha else (low, mid - 1)
    return low


def joint_cutoffs(good: DataFrame, stratum: str = "stratum", risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """Per stratum and rule the cutoff, where there is one: columns stratum, rule,
    cutoff, n_good, n_rejected (by any rule), bound (on the share that all
    rules together reject). ``good`` has the rule columns of the labelled good
    documents. The documents a stratum may lose are dealt evenly to the rules,
    the first ones in order first. Spark counts by stratum and grid cells; the
    driver sees how many strata have how many documents, up to a number that
    suffices for any."""
    grid = F.array(*[F.lit(g) for g in GRID])
    cell = lambda r: F.size(F.filter(grid, lambda g: g < F.col(r)))
    cells = common.written(
        good.select(F.col(stratum).alias("stratum"), *[cell(r).alias(r) for r in RULES])
        .groupBy("stratum", *RULES).agg(F.count(F.lit(1)).alias("n")), "rule-cells")
    needed = lambda parts: math.ceil(math.log(delta / parts) / math.log1p(-risk))
    sizes = (cells.groupBy("stratum").agg(F.sum("n").alias("n"))
             .groupBy(F.least("n", F.lit(needed(10 ** 9)).cast("long")).alias("n")).agg(F.count(F.lit(1)).alias("strata")).collect())
    parts = 1  # no more strata than parts get cutoffs
    while sum(r["strata"] for r in sizes if r["n"] >= needed(parts)) > parts:
        parts += 1
    alpha = delta / parts
    columns = ["stratum", "rule", "cutoff", "n_good", "n_rejected", "bound"]

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        at, left = group[list(RULES)].to_numpy(), group["n"].to_numpy().copy()
        n = int(left.sum())
        blocks = blocks_for(n, risk, alpha)
        found, rejected = [], np.zeros(len(group), bool)
        for i, rule in enumerate(RULES):
            own = blocks // len(RULES) + (i < blocks % len(RULES))
            if not own:
                break
            order = np.lexsort((*at.T, at[:, i]))[::-1]  # equal cells of the rule: by all cells
            taken = np.minimum(left[order], np.maximum(0, own - (np.cumsum(left[order]) - left[order])))
            last = int(at[order[np.flatnonzero(taken)[-1]], i])
            left[order] -= taken
            if last < len(GRID):
                rejected |= at[:, i] > last
                found.append((rule, GRID[last]))
        lost, bound = int(group["n"].to_numpy()[rejected].sum()), upper_bound(blocks - 1, n, alpha) if blocks else 1.0
        return pd.DataFrame([(group["stratum"].iloc[0], r, c, n, lost, bound) for r, c in found], columns=columns)

    return cells.groupBy("stratum").applyInPandas(
        choose, "stratum string, rule string, cutoff long, n_good long, n_rejected long, bound double")


def judged(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", risk: float = 0.01,
           delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, failed_rules
    (names) and kept.

    Base rule: fewer than 20 words, or over 30 % of the words in 8-word
    windows that occur twice. Holdout: labelled documents with quality 1, not
    toxic and not failed by the base rule; a document with several labels is
    good only if all say so. Documents in strata without admitted cutoffs are
    judged by the base rule alone. Null ids match no label; a null stratum is
    the stratum ''. Repeated documents get a row each. Empty tables give no
    rows or no cutoffs.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                         F.col(text_col).alias("text"))
    stats = common.written(with_stats(source, "text"), "rule-stats")
    stats = stats.select("*", *[F.expr(f"CAST({e} AS double)").alias(r) for r, e in RULES.items()]).withColumn(
        "base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
    clean = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(F.coalesce(F.col("quality") == 1, F.lit(False))
                        & F.coalesce(F.col("toxic") == 0, F.lit(True))).alias("good"))
             .where("good").select("doc_id"))
    good = stats.join(clean, "doc_id", "left_semi").where(~F.col("base_failed"))
    limits = (joint_cutoffs(good, "stratum", risk, delta).groupBy("stratum")
              .pivot("rule", list(RULES)).agg(F.max("cutoff")))
    limits = limits.select("stratum", *[F.col(r).alias(f"limit_{r}") for r in RULES])
    broken = F.array_compact(F.array(*[F.when(F.col(r) > F.col(f"limit_{r}"), F.lit(r)) for r in RULES]))
    return (stats.join(limits, "stratum", "left")
            .select("doc_id", *COUNTS, "base_failed", broken.alias("failed_rules"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))
