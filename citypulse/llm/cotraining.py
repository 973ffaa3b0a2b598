"""Quality classification by co-training two views of a document.

The text view sees hashed words and the shape of the text; the metadata view
sees the other columns (source, language, length). Each is a logistic
regression. In each round every view scores all unlabelled documents, and
documents on which it is confident become pseudo-labelled examples for the
other view. Both views are calibrated (Platt) on all labelled rows outside the
fit, counted by narrow bins of their odds; the log odds are added, the cutoff
is taken from the same rows, and all documents are scored.

The regressions are fitted on bounded samples of rows (``most_labelled``,
``most_pseudo`` per view and round, ``most_bytes`` of features); everything else
covers all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common
from citypulse.llm.rules import text_stats

TEXT_SIZE, META_SIZE = 1 << 16, 1 << 12
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: shape statistics: name, numerator, denominator
SHAPES = [("symbols", "n_symbols", "n_words"), ("dup", "n_dup_lines", "n_lines"), ("repeat", "n_repeat_words", "n_words"),
          ("chars", "word_chars", "n_words"), ("upper", "n_upper", "word_chars"), ("marks", "n_marks", "n_words"),
          ("echo", "n_echo", "n_words")]


def text_features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct feature numbers of each text: the last 80 for shapes (a level
    of each statistic), the others for words (letters, digits, beyond ASCII)."""
    stats = text_stats(data, offsets)
    low = common.LOWER[data]
    start, end, first = common.words_of(low, offsets, _IN_WORD)
    hashes = common.word_hashes(low, start, end)
    words = (hashes % np.uint64(TEXT_SIZE - 80)).astype(np.int32)
    same = np.zeros(len(hashes) + 1, np.int64)
    same[2:] = np.cumsum(hashes[1:] == hashes[:-1])[:len(hashes) - 1] if len(hashes) > 1 else 0
    stats["n_echo"] = same[first[1:]] - same[np.minimum(first[:-1] + 1, first[1:])]  # words like the one before
    shape = np.empty((len(offsets) - 1, len(SHAPES) + 1), np.int32)
    for i, (_, top, under) in enumerate(SHAPES):
        level = np.log2(1 + 64 * stats[top] / np.maximum(stats[under], 1)).round().clip(0, 8)
        shape[:, i] = TEXT_SIZE - 80 + 9 * i + level
    shape[:, -1] = TEXT_SIZE - 10 + np.log2(1 + stats["n_words"] / 8).round().clip(0, 9)
    return [np.concatenate((np.unique(words[a:b]), s)) for a, b, s in zip(first[:-1], first[1:], shape)]


def features(docs: DataFrame, id_col: str, text_col: str, meta_cols: list[str]) -> DataFrame:
    """(doc_id, text_f, meta_f): feature numbers as packed 16-bit integers."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(
        (F.floor(F.log2(F.col(c).cast("double") + 1) * 2) if docs.schema[c].dataType.typeName() in ("long", "integer", "double")
         else F.col(c)).cast("string"), F.lit(""))) for c in meta_cols]
    crossed = [F.concat(a, F.lit("&"), b) for i, a in enumerate(parts) for b in parts[:i]]
    meta = F.transform(F.array(*parts, *crossed), lambda x: F.pmod(F.xxhash64(x), F.lit(META_SIZE)).cast("int"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"), meta.alias("meta"))

    def run(batches_in):
        for batch in batches_in:
            for part in common.by_bytes(batch, "text"):
                found = text_features(*common.text_bytes(part.column("text")))
                meta = part.column("meta")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([f.astype("<u2").tobytes() for f in found], pa.binary()),
                     pa.array([np.array(m, "<u2").tobytes() for m in meta.to_pylist()], pa.binary())],
                    names=["doc_id", "text_f", "meta_f"])

    return common.map_arrow(source, run, "doc_id long, text_f binary, meta_f binary")


def _ragged(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, packed), np.int64, len(packed)) // 2
    return np.frombuffer(b"".join(packed), "<u2").astype(np.int64), np.concatenate(([0], np.cumsum(size)))


def _sums(values: np.ndarray, edge: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[edge[1:]] - total[edge[:-1]]


def log_odds(weights: np.ndarray, packed: list[bytes]) -> np.ndarray:
    """Of each row: the bias (last weight) and the weights of its features."""
    index, edge = _ragged(packed)
    return weights[-1] + _sums(weights[index], edge)


def fit(packed: list[bytes], good: np.ndarray, weight: np.ndarray, size: int, always: int = 0,
        steps: int = 200, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression by Adagrad on all rows per step; last entry: bias.

    Only features in at least 5 rows whose share of good rows differs from the
    whole by more than 4 standard errors take part, and the last ``always``
    ones; with the many words of a text, others would be learnt by heart."""
    w, past = np.zeros(size + 1), np.full(size + 1, 1e-8)
    if not len(packed):
        return w
    index, edge = _ragged(packed)
    row = np.repeat(np.arange(len(packed)), np.diff(edge))
    total, mean = weight.sum(), (weight * good).sum() / weight.sum()
    seen, of_good = np.bincount(index, weight[row], size), np.bincount(index, (weight * good)[row], size)
    z = np.abs(of_good - seen * mean) / np.sqrt(np.maximum(seen * mean * (1 - mean), 1e-9))
    use = (z > 4) & (seen >= 5)
    use[size - always:] = True
    index, row = index[use[index]], row[use[index]]
    for _ in range(steps):
        odds = w[-1] + np.bincount(row, w[index], len(packed))
        error = weight * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - good) / total
        slope = np.append(np.bincount(index, error[row], size) + decay * w[:-1], error.sum())
        past += slope * slope
        w -= rate * slope / np.sqrt(past)
    return w


BINS = 64  #: bins per unit of log odds
EDGE = 40  #: odds beyond are counted in the last bin on their side


def platt(x: np.ndarray, good: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
    """a, b such that a * x + b are calibrated log odds, from bins at the odds
    x with so many rows, good ones among them (Newton's method with a little
    smoothing); without both classes the odds stay as they are."""
    if not 0 < good.sum() < rows.sum():
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = rows * p - good, rows * np.maximum(p * (1 - p), 1e-6)
        slope = np.array([(g * x).sum() + 1e-3 * (a - 1), g.sum()])
        curve = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(curve, slope), -1, 1)
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.0)), float(b)


def binned(scored: DataFrame, **odds: Column) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each named odds: its bins in ascending order, as (middle, good rows,
    all rows). One aggregate, at most 2 * EDGE * BINS + 2 rows a name; odds that are not
    numbers count as 0."""
    place = lambda x: F.floor(F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), F.when(F.isnan(x), 0.0).otherwise(x))) * BINS)
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), place(x).alias("bin")) for name, x in odds.items()]))
    rows = (scored.select("good", each.alias("at")).groupBy("at.name", "at.bin")
            .agg(F.sum("good").alias("good"), F.count("*").alias("rows")).collect())
    out = {}
    for name in odds:
        mine = sorted((r["bin"], r["good"], r["rows"]) for r in rows if r["name"] == name)
        place_, good, many = (np.array([m[i] for m in mine], float) for i in range(3))
        out[name] = ((place_ + 0.5) / BINS, good, many)
    return out


def best_cutoff(odds: np.ndarray, good: np.ndarray, rows: np.ndarray, most_lost: float) -> float | None:
    """The lower edge, in odds, of what is kept: the edge of a bin under which
    most more bad than good rows lie, among those that lose at most
    ``most_lost`` of the good ones; None if no edge gains."""
    lost = np.concatenate(([0], np.cumsum(good)))
    caught = np.concatenate(([0], np.cumsum(rows - good)))
    gain = np.where(lost <= most_lost * good.sum(), caught - lost, -1)
    best = int(np.argmax(gain))
    return None if gain[best] <= 0 else float(odds[best - 1] + 0.5 / BINS)


def _share(key: str, share: float):
    """A fixed pseudo-random share of the rows."""
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(key)), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, share)))


def _bounded(rows: DataFrame, view: str | None, key: str, most: int, most_bytes: int) -> list:
    """A sample of at most ``most`` rows and about ``most_bytes`` of features (of one view or
    both), whatever the ids: rows that share one are picked by their features."""
    views = [view] if view else ["text_f", "meta_f"]
    many, size = rows.agg(F.count("*"), F.sum(sum(F.octet_length(v) for v in views))).first()
    share = min(most, many * most_bytes / max(1, size or 0)) / max(1, many)
    some = rows.where(_share(key, share)).select(*views, "good", F.xxhash64("doc_id", F.lit(key)).alias("by"), F.xxhash64(*views).alias("then"))
    return some.orderBy("by", "then").limit(max(1, int(many * min(1.0, share)))).collect()


def classify(docs: DataFrame, labels: DataFrame, rounds: int = 2, most_labelled: int = 12_000,
             most_pseudo: int = 2_000, confidence: float = 0.98, most_lost: float = 0.005,
             id_col: str = "doc_id", text_col: str = "text",
             meta_cols: tuple[str, ...] = ("source", "lang", "n_chars"), most_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, p_text, p_meta, score, kept) of every row of ``docs``.

    Good means quality 1 and not toxic, by every label of the document. score
    is the calibrated probability of being good; a document is kept unless its
    score is under the cutoff: the best one on the labelled rows outside the fit
    (a fifth of them or more, all of them counted, by bins of 1/64 of the log
    odds) among those that lose at most ``most_lost`` of the good ones there.
    Without usable labels all are kept with score 0.5. Null
    ids have no label, null texts are empty, null metadata is a value of its
    own; missing metadata columns are left out; rows are scored each for
    itself. The fit's samples, the only rows that reach the driver, are bounded by
    ``most_labelled``, ``most_pseudo`` and ``most_bytes`` (an eighth of it a view and
    round for pseudo-labels).
    """
    metas = [c for c in meta_cols if c in docs.columns]
    known = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min(((F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("int")).alias("good")))
    views_only = common.written(features(docs, id_col, text_col, metas), "views")
    table = common.written(views_only.join(known, "doc_id", "left"), "views")  # good: null if unlabelled
    common.dropped(views_only)
    common.release(docs.sparkSession)
    labelled = table.where("good IS NOT NULL")
    found = labelled.count()
    in_fit = _share("labelled", most_labelled / max(1, found)) & ~_share("apart", 0.2)
    train = _bounded(labelled.where(in_fit), None, "labelled", most_labelled, most_bytes)
    apart = labelled.where(~in_fit)
    views = {"text_f": TEXT_SIZE, "meta_f": META_SIZE}
    given = {v: ([bytes(r[v]) for r in train], [r["good"] for r in train], [1.0] * len(train)) for v in views}
    learn = lambda v: fit(given[v][0], np.array(given[v][1], float), np.array(given[v][2]), views[v], 80 if v == "text_f" else 0)

    def calibrated() -> dict[str, tuple[float, float]]:
        raw = with_odds(apart, models, {v: (1.0, 0.0) for v in views}, "good int")
        return {v: platt(*bins) for v, bins in binned(raw, **{v: F.col(f"{v}_odds") for v in views}).items()}

    models = {v: learn(v) for v in views}
    scales = calibrated()
    unlabelled = table.where("good IS NULL")
    for turn in range(rounds if train else 0):
        scored = with_odds(unlabelled, models, scales)
        sure = float(np.log(confidence / (1 - confidence)))
        side = lambda v: F.when(F.col(f"{v}_odds") > sure, 1).when(F.col(f"{v}_odds") < -sure, 0)
        for v, other in (("text_f", "meta_f"), ("meta_f", "text_f")):
            confident = scored.select("doc_id", other, side(v).alias("good")).where("good IS NOT NULL")
            for r in _bounded(confident, other, f"{v}{turn}", most_pseudo, most_bytes // 8):
                given[other][0].append(bytes(r[other]))
                given[other][1].append(r["good"])
                given[other][2].append(0.5)
        models = {v: learn(v) for v in views}
        scales = calibrated()

    total = F.col("text_f_odds") + F.col("meta_f_odds")
    odds, good, rows = binned(with_odds(apart, models, scales, "good int"), both=total)["both"]
    prior = float(np.log((good.sum() + 1) / (rows.sum() - good.sum() + 1))) if len(rows) else 0.0
    edge = best_cutoff(odds, good, rows, most_lost) if train and 0 < good.sum() < rows.sum() else None
    chance = lambda x: 1 / (1 + F.exp(-x))
    scored = with_odds(table, models, scales)
    score = chance(total - F.lit(prior)) if train else F.lit(0.5)
    kept = F.lit(True) if edge is None else total >= F.lit(edge)
    return scored.select("doc_id", chance(F.col("text_f_odds")).alias("p_text"), chance(F.col("meta_f_odds")).alias("p_meta"),
                         score.alias("score"), kept.alias("kept"))


def with_odds(table: DataFrame, models: dict[str, np.ndarray], scales: dict[str, tuple[float, float]],
              more: str = "") -> DataFrame:
    """Adds the calibrated log odds of both views to doc_id, the features and one column
    ``more`` (name and type). The weights (under 600 KB, whatever the input) travel with the function."""
    kept = ["doc_id", "text_f", "meta_f", *more.split(" ")[:1]] if more else ["doc_id", "text_f", "meta_f"]
    weights = {v: w.astype(np.float32) for v, w in models.items()}

    def run(batches_in):
        for batch in batches_in:
            if batch.num_rows:
                odds = [pa.array(scales[v][0] * log_odds(weights[v], batch.column(v).to_pylist()) + scales[v][1], pa.float64())
                        for v in ("text_f", "meta_f")]
                yield pa.RecordBatch.from_arrays([*batch.columns, *odds], names=[*batch.schema.names, "text_f_odds", "meta_f_odds"])

    return common.map_arrow(table.select(*kept), run, "doc_id long, text_f binary, meta_f binary, " + (f"{more}, " if more else "")
                            + "text_f_odds double, meta_f_odds double")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """``docs`` without the documents that the classifier rejects; of rows
    with one id all stay if one is kept, rows with a null id all stay."""
    bad = (classify(docs, labels, id_col=id_col, **more).groupBy("doc_id").agg(F.max("kept").alias("kept"))
           .where("NOT kept").select(F.col("doc_id").alias("bad_id")))
    return docs.join(bad, docs[id_col].cast("long") == bad["bad_id"], "left_anti")
