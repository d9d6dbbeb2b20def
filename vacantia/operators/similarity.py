"""Token-set similarity of titles and labels, and the best label of each title.

Pairs in which one side's words are all in the other score 100; Spark finds them by an equality join on words.
For the other titles the score is computed in Arrow batches against the label list, with bit-parallel longest
common subsequences and only for labels whose upper bound reaches the cutoff. Labels go to the workers in
blocks of at most ``BLOCK``, so a long list takes more passes, not more memory."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacantia.functions.text import clean_title
from vacantia.runtime import ship_package

BLOCK = 5_000


def lcs(a: str, b: str) -> int:
    """The length of the longest common subsequence, by one integer addition per letter of ``b``."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    row, full = (1 << len(a)) - 1, (1 << len(a)) - 1
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _share(edits: int, length: int) -> float:
    return 100.0 - 100.0 * edits / length if length else 100.0


def token_set_ratio(a: str, b: str, floor: float = 0.0) -> float:
    """0 to 100: how alike two texts are as sets of words; 0 if either has none, or if the score is below ``floor``.

    100 if one set holds the other. Else the best of three comparisons: common words with both sides' rests, and
    common words alone with either; each by insertions and deletions as a share of both lengths."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common = x & y
    if common and (common == x or common == y):
        return 100.0
    left, right = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    base = len(" ".join(sorted(common)))
    gap = 1 if base else 0
    alone = max(_share(gap + len(left), 2 * base + gap + len(left)), _share(gap + len(right), 2 * base + gap + len(right))) if base else 0.0
    total = 2 * (base + gap) + len(left) + len(right)
    bound = sum((Counter(left) & Counter(right)).values())
    if _share(len(left) + len(right) - 2 * bound, total) < max(floor, alone):
        both = 0.0
    else:
        both = _share(len(left) + len(right) - 2 * lcs(left, right), total)
    score = max(both, alone)
    return score if score >= floor else 0.0


class LabelIndex:
    """Labels by their words and lengths, to find the best one for a text without scoring them all.

    Labels that share a word are found by it, and bounded by the lengths of what remains; labels that share none
    only matter if their length is near the text's. ``best`` gives what scoring every label in order would."""

    def __init__(self, labels: list[tuple[int, str]]):
        self.at = [i for i, _ in labels]
        self.words = [frozenset(t.split()) for _, t in labels]
        self.length = [len(" ".join(w)) for w in self.words]
        self.letters = [Counter(" ".join(w)) for w in self.words]
        self.holders: dict[str, list[int]] = {}
        for j, ws in enumerate(self.words):
            for w in ws:
                self.holders.setdefault(w, []).append(j)
        self.by_length = sorted((n, j) for j, n in enumerate(self.length))

    def best(self, text: str, cutoff: float) -> tuple[int, float] | None:
        x = set(text.split())
        n = len(" ".join(x))
        shared: dict[int, int] = {}
        for w in x:
            for j in self.holders.get(w, ()):
                shared[j] = shared.get(j, 0) + len(w) + 1
        best, at = cutoff, None
        bounds = []
        for j, letters in shared.items():
            # lengths of the common words and of both rests, each joined by blanks
            base, left, right = letters - 1, max(n - letters, 0), max(self.length[j] - letters, 0)
            alone = 100.0 if not left or not right else max(_share(1 + left, 2 * base + 1 + left), _share(1 + right, 2 * base + 1 + right))
            bounds.append((max(alone, _share(abs(left - right), 2 * (base + 1) + left + right)), -j))
        if n:
            # edits are no fewer than the difference of the lengths, a share of 1 - cutoff of their sum at most
            spread = (100.0 - cutoff) / 100.0
            low, high = n * (1 - spread) / (1 + spread), n * (1 + spread) / max(1 - spread, 1e-9)
            own = Counter(" ".join(x))
            for k in range(bisect_left(self.by_length, (int(low), -1)), len(self.by_length)):
                size, j = self.by_length[k]
                if size > high + 1:
                    break
                if j not in shared:
                    common = sum((own & self.letters[j]).values())
                    bounds.append((_share(n + size - 2 * min(common, n, size), n + size), -j))
        for bound, j in sorted(bounds, reverse=True):
            if bound < best - 1e-9:
                break
            score = token_set_ratio(text, " ".join(self.words[-j]), best)
            if score >= best and score > 0 and (at is None or score > best or -j < at):
                best, at = score, -j
        return None if at is None else (self.at[at], best)


def numbered_labels(labels: DataFrame) -> DataFrame:
    """isco_code, label, label_idx, key: labels in the order (isco_code, label_kind, label), which decides ties.

    Rows alike in code and lower-case label count once; labels that clean to '' are left out. A label list is a
    reference table that fits one task."""
    once = labels.groupBy("isco_code", F.lower("label").alias("_l")).agg(F.min(F.struct("label_kind", "label")).alias("m")).select("isco_code", "m.label_kind", "m.label")
    ordered = once.withColumn("label_idx", F.row_number().over(Window.orderBy("isco_code", "label_kind", "label")))
    return ordered.select("isco_code", "label", "label_idx", clean_title(F.col("label")).alias("key")).filter("key <> ''")


def subset_matches(titles: DataFrame, labels: DataFrame) -> DataFrame:
    """key, label_idx: pairs of which one side's words are all in the other, by an equality join on words."""
    def words(df: DataFrame) -> DataFrame:
        return df.withColumn("w", F.array_distinct(F.split("key", " "))).withColumn("n", F.size("w"))

    left = words(titles.select("key")).select("key", F.col("n").alias("n_title"), F.explode("w").alias("word"))
    right = words(labels.select("key", "label_idx")).select("label_idx", F.col("n").alias("n_label"), F.explode("w").alias("word"))
    shared = left.join(right, "word").groupBy("key", "label_idx", "n_title", "n_label").agg(F.count("*").alias("n"))
    return shared.filter("n = n_title OR n = n_label").select("key", "label_idx")


def _scored(keys: DataFrame, block: list[tuple[int, str]], cutoff: float) -> DataFrame:
    ship_package(keys.sparkSession)
    shared = keys.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LabelIndex(shared.value)
        for batch in batches:
            found: dict[str, list] = {"key": [], "label_idx": [], "score": []}
            for key in batch.column(0).to_pylist():
                hit = index.best(key, cutoff)
                if hit is not None:
                    found["key"].append(key)
                    found["label_idx"].append(hit[0])
                    found["score"].append(hit[1])
            yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("key", pa.string()), ("label_idx", pa.int32()), ("score", pa.float64())]))

    return keys.mapInArrow(run, "key string, label_idx int, score double")


def best_labels(titles: DataFrame, labels: DataFrame, cutoff: float = 85.0) -> DataFrame:
    """title, isco_code, label, score of each title that has a label scoring ``cutoff`` at least.

    Of equal scores the first label in order holds. Null and empty titles, and empty label lists, match nothing."""
    keyed = titles.select("title", clean_title(F.col("title")).alias("key")).filter("key <> ''")
    keys = keyed.select("key").distinct()
    listed = numbered_labels(labels)
    whole = subset_matches(keys, listed).groupBy("key").agg(F.min("label_idx").alias("label_idx")).withColumn("score", F.lit(100.0))
    rows = [(r["label_idx"], r["key"]) for r in listed.select("label_idx", "key").orderBy("label_idx").toLocalIterator()]
    # few bytes but much work: a fixed number of partitions, which adaptive execution does not merge
    rest = keys.join(whole, "key", "left_anti").repartition(int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    blocks = [_scored(rest, rows[i : i + BLOCK], cutoff) for i in range(0, len(rows), BLOCK)]
    scored = whole.select("key", "label_idx", "score")
    if blocks:
        near = reduce(DataFrame.unionByName, blocks).groupBy("key").agg(F.max(F.struct("score", (-F.col("label_idx")).alias("i"))).alias("m"))
        scored = scored.unionByName(near.select("key", (-F.col("m.i")).alias("label_idx"), "m.score"))
    return keyed.join(scored, "key").join(listed.select("label_idx", "isco_code", "label"), "label_idx").select("title", "isco_code", "label", "score")
