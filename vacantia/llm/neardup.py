"""Problem 1: the same opening advertised again with small differences.

Method: Bayesian candidate pruning. Wordings of one company whose MinHash values agree in a band become candidates;
their signatures are compared piece by piece, and a pair is dropped as soon as the posterior probability that its
similarity reaches ``THRESHOLD`` falls under ``TOLERANCE``; of the rest the similarity is computed exactly, and the
words that differ are looked at.

Every distinct wording (company, rank, words of the title) is a node that asks. Representatives answer: the wordings
that slips of spelling are read as. They ask all other representatives, the others ask the one they are read as. A slip is told by the corpus, by ratios alone: a word is read as a far more
frequent one of the same kind within two edits (an edit also being a swap), or as two or three neighbours written
together. Water and Waste, two edits apart and equally frequent, stay two words. A wording that reaches its
representative through bands, pruning and similarity is its member, and members are never compared with each
other, so a hot opening costs a link per wording and not one per pair of them. Representatives that are alike but for words
one edit apart (Colour and Color), letters in another order (Data Base and Database) or doubtful slips are linked.
No count or size decides anything, so tables of any size are treated alike.

``SHINGLE`` letters of a word make a shingle. TESTDATA.md asks for the same company, occupation, seniority,
subject, team and town, not for shingles of five words, so the threshold is one on letters of the title's words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.labelmatch import SENIORITY, plain_sql, words_sql
from vacantia.runtime import Scratch, cut_lineage, once, shuffles_dropped, ship_package

# Words of advertising, of contracts and of places' surroundings, legal forms and countries.
ADVERTS = ("hiring", "now", "new", "repost", "urgent", "ref", "full", "part", "time", "permanent", "temporary", "month", "contract", "hybrid", "remote", "apply", "team", "the", "and")
LEGAL = ("ltd", "limited", "gmbh", "plc", "inc", "incorporated", "bv", "nv", "group", "the", "llc", "llp", "ag", "se", "sa", "sarl", "sas", "ab", "oy", "co", "company", "corp", "corporation", "pty", "pvt", "holding", "holdings")
PLACES = ("greater", "area", "remote", "hybrid", "city", "of", "near", "ireland", "united", "kingdom", "germany", "states", "america", "france", "netherlands", "india", "australia", "canada", "poland", "sweden", "switzerland", "singapore", "austria", "belgium", "spain", "portugal", "italy", "denmark", "norway", "finland")
# The spellings of each seniority.
RANKS = {"senior": ("senior", "sr", "snr"), "junior": ("junior", "jr", "jnr"), "lead": ("lead",), "graduate": ("graduate", "grad"), "principal": ("principal", "princ")}

#: Letters of a shingle; MinHash values of a signature (8 bits each); bands and values of a band.
SHINGLE, VALUES, BANDS, ROWS = 3, 80, 20, 4
#: Similarity of title words from which wordings may be the same, and the posterior probability under which pairs are dropped.
THRESHOLD, TOLERANCE = 0.5, 0.001
#: What marks a word that may be a slip of several, or is not near enough to one.
DOUBT = "?"
#: How many times more frequent a word must be for a similar one to count as its slip (names of companies less at one
#: edit and more at two).
RATIO, NAME_RATIO, FAR_RATIO = 8, 3, 20
#: Fewest letters of words of which one edit makes no other word.
LONG = 5
#: SQL: whether two names of companies are so near that one may be a slip of the other.
NEAR_NAME = "(levenshtein({0}, {1}) <= IF(least(length({0}), length({1})) >= 7, 2, 1) OR (array_sort(split({0}, '')) = array_sort(split({1}, ''))))"


def typed_words(postings: DataFrame) -> DataFrame:
    """posting_id, rid (a number of its own) and the words of title, company and town, and the rank, of each typed posting with a company."""
    live = postings.filter("posting_id IS NOT NULL AND company IS NOT NULL").select("posting_id", F.coalesce("title", F.lit("")).alias("title"), "company", F.coalesce("location_raw", F.lit("")).alias("place"))
    parts = rf"split({plain_sql('title')}, '[\\s ]+[-–—]+|[-–—]+[\\s ]+|[–—:|/,;()\\[\\]{{}}#*0-9]+')"
    x = once(live.withColumn("rid", F.monotonically_increasing_id()), "p", F.expr(f"transform({parts}, p -> {words_sql('p', ADVERTS)})"))
    ranks = " ".join(f"WHEN arrays_overlap(w, array({', '.join(repr(x) for x in names)})) THEN '{rank}'" for rank, names in RANKS.items())
    x = x.selectExpr("posting_id", "rid", "p", "flatten(p) AS w", f"array_distinct({words_sql(plain_sql('company'), LEGAL)}) AS c", f"array_distinct({words_sql(plain_sql('place'), PLACES)}) AS t")
    rankless = f"filter(transform(p, p -> filter(p, w -> length(w) > 1 AND w NOT IN ({', '.join(repr(s) for s in SENIORITY)}))), p -> size(p) > 0)"
    return x.selectExpr("posting_id", "rid", f"CASE {ranks} ELSE '' END AS rank", f"{rankless} AS phrases", "filter(c, w -> length(w) > 1) AS company", "filter(t, w -> length(w) > 2) AS town").filter("size(company) > 0")


def _deletions(word: str, times: str) -> str:
    """SQL: a word and what is left of it after taking out one letter, or two where ``times`` is 2."""
    one = f"transform(sequence(1, length({word})), i -> concat(substring({word}, 1, i - 1), substring({word}, i + 1)))"
    two = f"flatten(transform({one}, v -> transform(sequence(1, length(v)), i -> concat(substring(v, 1, i - 1), substring(v, i + 1)))))"
    return f"array_distinct(concat(array({word}), {one}, IF({times} = 2, {two}, CAST(array() AS ARRAY<STRING>))))"


def _spread(df: DataFrame, key: str) -> DataFrame:
    """A table of words in as many parts as a shuffle has, as many rows are made of each word.

    What they become is joined with the hint ``merge``: the optimiser takes it for as small as the table of words."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def corrections(typed: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """kind, word, read: what slips are read as (one word, or more with blanks, or itself with ``DOUBT``); kind is w (title), c (company) or t (town)."""
    each = [("w", F.flatten("phrases")), ("c", F.col("company")), ("t", F.col("town"))]
    words = reduce(DataFrame.unionByName, [typed.select(F.lit(k).alias("kind"), F.explode(c).alias("word")) for k, c in each])
    # vocabularies, used several times below
    counted = keep(words.groupBy("kind", "word").agg(F.count("*").alias("n")))
    runs = F.transform(F.sequence(F.lit(2), F.least(F.size("p"), F.lit(3))), lambda n: F.transform(F.sequence(F.lit(1), F.size("p") - n + 1), lambda i: F.array_join(F.slice("p", i, n), " ")))
    neighbours = typed.select(F.explode("phrases").alias("p")).filter("size(p) > 1").select(F.explode(F.flatten(runs)).alias("read"))
    joined = keep(neighbours.groupBy("read").agg(F.count("*").alias("n"))).select(F.lit("w").alias("kind"), F.replace("read", F.lit(" "), F.lit("")).alias("word"), "n", "read")
    # a run's joined form itself is its slip if no more frequent; slips of it must be far rarer, as of any word
    written = counted.join(joined.select("kind", "word", F.col("n").alias("often"), "read"), ["kind", "word"]).filter("often >= n").select("kind", "word", "n", F.col("word").alias("target"), "often", "read")
    targets = counted.withColumn("read", F.col("word")).unionByName(joined.filter(F.col("n") >= RATIO))
    times = "IF(length(word) >= 7, 2, 1)"
    ratio = F.when(F.col("kind") == "c", NAME_RATIO).otherwise(RATIO)
    left = _spread(counted.filter("length(word) >= 4"), "word").selectExpr("kind", "word", "n", f"explode({_deletions('word', times)}) AS v")
    right = _spread(targets.filter((F.col("n") >= ratio) & (F.length("word") >= 4)), "word").selectExpr("kind", "word AS target", "n AS often", "read", f"explode({_deletions('word', times)}) AS v")
    met = left.hint("merge").join(right, ["kind", "v"]).filter(F.col("often") >= ratio * F.col("n")).select("kind", "word", "n", "target", "often", "read").unionByName(written).filter("word <> read").distinct()
    # two letters swapped are one edit, as are those that levenshtein counts as one
    swapped = "length(word) = length(target) AND array_sort(split(word, '')) = array_sort(split(target, ''))"
    near = met.withColumn("d", F.levenshtein("word", "target", 2)).filter("d >= 0").withColumn("d", F.expr(f"IF({swapped}, 1, d)")).filter("d <= 1 OR length(word) >= 7")
    # made-up names may be two edits apart and still two names
    near = near.filter((F.col("d") <= 1) | (F.col("kind") != "c") | (F.col("often") >= FAR_RATIO * F.col("n")))
    best = near.groupBy("kind", "word").agg(F.sort_array(F.collect_set(F.struct("d", (-F.col("often")).alias("often"), "read"))).alias("l"))
    # a title's slip that is as near to two words, or two edits from one, stays as it is, marked, for the comparison of pairs to judge
    open_slip = (F.col("kind") == "w") & F.expr("l[0].d = 2 OR (size(l) > 1 AND l[1].d = l[0].d)")
    return best.select("kind", "word", F.when(open_slip, F.concat("word", F.lit(DOUBT))).otherwise(F.col("l")[0]["read"]).alias("read"))


def canonical(typed: DataFrame, fixed: DataFrame) -> DataFrame:
    """posting_id, rank, company, raw, words, doubt, town: the title's words as typed and as read (both sorted), and those read with doubt.

    ``typed`` must be written (cut from its lineage), so that its row numbers hold. Only the few words that have a
    correction (``fixed``, from ``corrections``) are brought back to their rows, as one small map a row."""

    def of_kind(kind: str, words: Column) -> Column:
        return F.transform(words, lambda w: F.struct(F.lit(kind).alias("kind"), w.alias("word")))

    every = F.array_distinct(F.concat(of_kind("w", F.flatten("phrases")), of_kind("c", F.col("company")), of_kind("t", F.col("town"))))
    hits = typed.select("rid", F.explode(every).alias("p")).select("rid", "p.*").join(fixed, ["kind", "word"])
    maps = hits.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("kind", "word"), "read"))).alias("fix"))
    rows = typed.join(maps, "rid", "left")

    def read(kind: str, words: Column) -> Column:
        return F.transform(words, lambda w: F.coalesce(F.try_element_at("fix", F.concat(F.lit(kind), w)), w))

    def tidy(words: Column) -> Column:
        return F.array_sort(F.array_distinct(words))

    said = once(rows, "_read", F.split(F.array_join(read("w", F.flatten("phrases")), " "), " "))
    plain = F.transform("_read", lambda w: F.replace(w, F.lit(DOUBT), F.lit("")))
    doubt = F.transform(F.filter("_read", lambda w: F.endswith(w, F.lit(DOUBT))), lambda w: F.replace(w, F.lit(DOUBT), F.lit("")))
    return said.select("posting_id", "rank", read("c", F.col("company")).alias("company"), tidy(F.flatten("phrases")).alias("raw"), F.filter(tidy(plain), lambda w: w != "").alias("words"), tidy(doubt).alias("doubt"), F.array_join(tidy(read("t", F.col("town"))), " ").alias("town"))


_SEEDS = np.random.default_rng(7)
_MULTIPLIERS = _SEEDS.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _SEEDS.integers(0, 2**63, VALUES, dtype=np.uint64)


#: Rounds in which the bands are compared, so that the keys of a few only are on disk at a time.
ROUNDS = 4


def _lows(lists: pa.ListArray) -> np.ndarray:
    """The MinHash values of each list of shingle hashes, 64 bits each."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    ends = np.asarray(lists.value_lengths()).cumsum()
    starts = np.concatenate([[0], ends[:-1]])
    lows = np.empty((len(lists), VALUES), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(VALUES):
            mixed = flat * _MULTIPLIERS[j] + _SHIFTS[j]
            mixed ^= mixed >> np.uint64(31)
            lows[:, j] = np.minimum.reduceat(mixed * np.uint64(0x9E3779B97F4A7C15), starts)
    return lows


def _minhash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """no, shingle hashes, block -> no, signature of VALUES bytes, band keys (with the block) by rounds."""
    for batch in batches:
        n, lows = batch.num_rows, _lows(batch.column(1))
        with np.errstate(over="ignore"):
            keys = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)[:, None] + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                keys = (keys ^ (keys >> np.uint64(29)) ^ lows[:, r * BANDS : (r + 1) * BANDS]) * np.uint64(0xBF58476D1CE4E5B9)
        words = (lows >> np.uint64(56)).astype(np.uint8).view(">i8").astype(np.int64)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())) for x in (words, *np.split(keys.view(np.int64), ROUNDS, axis=1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["no", "signature", *[f"bands{k}" for k in range(ROUNDS)]])


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, shingle hashes of two wordings of one block -> id of those that agree in a band and survive the pruning."""
    fewest = np.array(least_matches(16))
    for batch in batches:
        x, y = (_lows(batch.column(c)) for c in (1, 2))
        band = (x == y).reshape(-1, ROWS, BANDS).all(1).any(1)
        alike = ((x >> np.uint64(56)) == (y >> np.uint64(56))).cumsum(1)[:, 15::16]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(band & (alike >= fewest).all(1)))], names=["id"])


@cache
def least_matches(step: int = 16, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of values compared (``step``, 2 * ``step``, ...) the fewest matches with which a pair is kept.

    With a uniform prior on the probability s of a match, the posterior after m of n matches is Beta(m + 1, n - m + 1);
    values of 8 bits match by chance, so the threshold t stands for s = t + (1 - t) / 256."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    at = threshold + (1 - threshold) / 256
    out = []
    for n in range(step, VALUES + 1, step):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            dens = np.exp(log - log.max())
            if dens[grid >= at].sum() / dens.sum() >= tolerance:
                out.append(m)
                break
    return out


def _equal_bytes(a: Column, b: Column) -> Column:
    """How many of the eight bytes of two longs are equal."""
    x = a.bitwiseXOR(b)
    for bits in (4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, bits))
    return 8 - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))


def near_names(nodes: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut_lineage) -> DataFrame:
    """name, like: companies' first words that may be slips, and the near names, at least as frequent, that they may be slips of.

    Two edits need ``NAME_RATIO`` times the frequency: made-up names that are near are mostly two names."""
    names = nodes.groupBy(F.get("company", F.lit(0)).alias("name")).agg(F.count("*").alias("n")).filter("length(name) >= 4")
    keys = keep(_spread(names, "name").selectExpr("name", "n", f"explode({_deletions('name', '2')}) AS v"))
    met = keys.hint("merge").join(keys.selectExpr("name AS like", "n AS often", "v"), "v").filter("name <> like AND often >= n").select("name", "like", "n", "often").distinct()
    one = F.expr("levenshtein(name, like) = 1 OR array_sort(split(name, '')) = array_sort(split(like, ''))")
    return met.filter(NEAR_NAME.format("name", "like")).filter(one | (F.col("often") >= NAME_RATIO * F.col("n"))).select("name", "like")


def shingles(words: Column) -> Column:
    """The distinct hashed shingles of an array of words, their beginnings and ends marked."""
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.xxhash64(F.substring(F.concat(F.lit("^"), w, F.lit("$")), i, F.lit(SHINGLE)))))))


def _similar(x: str, y: str) -> Column:
    """Whether the Jaccard similarity of two columns of distinct shingles reaches ``THRESHOLD``; x and y with their common number ``both``."""
    return F.col("both") >= THRESHOLD * (F.size(x) + F.size(y) - F.col("both"))


def reached(nodes: DataFrame) -> DataFrame:
    """id: the wordings that reach the representative they are read as, through a band, the pruning and the similarity.

    A node has the words of its representative with it (``read``), so nothing is moved to compare them. What other
    representatives would answer such a wording makes neither members nor links, and is not asked."""
    each = nodes.filter("NOT rep").select("id", shingles(F.col("words")).alias("gx"), shingles(F.col("read")).alias("gy")).filter("size(gx) > 0 AND size(gy) > 0")
    each = once(each, "both", F.size(F.array_intersect("gx", "gy"))).filter(_similar("gx", "gy"))
    return each.select("id", "gx", "gy").mapInArrow(_meeting, "id bigint")


def candidates(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """x, y (ids of nodes): pairs of representatives of one company and rank that survive the pruning.

    Representatives whose company's name may be a slip of another also ask (and do not answer) under that name, with
    the number -1 - id. A band's key is hashed together with the company's first word and the rank, so no bucket goes
    beyond them; pairs are made by a join on that key, which adaptive execution splits where a bucket is hot. Both
    sides of it are one shuffle, and a round has some of the bands only."""
    block = lambda name: F.xxhash64(name, "rank")
    told = nodes.withColumn("name", F.get("company", F.lit(0)))
    near = scratch.keep(near_names(nodes, scratch.keep))
    reps = told.filter("rep")
    asks = reps.select(F.col("id").alias("no"), "words", block("name").alias("block")).unionByName(reps.join(near, "name").select((-1 - F.col("id")).alias("no"), "words", block("like").alias("block")))
    lists = ", ".join(f"bands{k} array<bigint>" for k in range(ROUNDS))
    signed = scratch.keep(asks.select("no", shingles(F.col("words")).alias("g"), "block").filter("size(g) > 0").mapInArrow(_minhash, f"no bigint, signature array<bigint>, {lists}"))
    signatures = scratch.keep(signed.filter("no >= 0").select("no", "signature"))
    rounds = []
    for k in range(ROUNDS):
        x, y = (signed.select(F.col("no").alias(c), F.explode(f"bands{k}").alias("key")) for c in "xy")
        # two representatives are one pair; those of two that only ask are left out below, not to make two shuffles of one
        rounds.append(scratch.keep(x.join(y, "key").filter("x < y").select("x", "y").distinct()))
    scratch.drop(signed)
    met = reduce(DataFrame.unionByName, rounds).filter("y >= 0").select(F.expr("IF(x < 0, -1 - x, x)").alias("x"), "y").filter("x <> y")
    pairs = scratch.keep(met.distinct())
    scratch.drop(*rounds)
    left, right = (signatures.select(F.col("no").alias(c), F.col("signature").alias(f"s{c}")) for c in "xy")
    # piece by piece: a pair that is dropped is not compared any further
    step = 2
    alive = pairs.join(left, "x").join(right, "y").withColumn("m", F.lit(0))
    for k, fewest in enumerate(least_matches(8 * step)):
        more = reduce(lambda x, y: x + y, [_equal_bytes(F.get("sx", F.lit(step * k + i)), F.get("sy", F.lit(step * k + i))) for i in range(step)])
        alive = once(alive.withColumnRenamed("m", "before"), "m", F.col("before") + more).drop("before").filter(F.col("m") >= fewest)
    alive = scratch.keep(alive.select("x", "y"))
    scratch.drop(signatures, pairs)
    return alive


#: SQL: whether two companies (arrays of words) may be one, and whether their first words are only near.
_COMPANY = "(size({0}) < 2 OR size({1}) < 2 OR get({0}, 1) = get({1}, 1) OR levenshtein(get({0}, 1), get({1}, 1)) <= 2)"
_NEAR = "length({0}) >= 5 AND length({1}) >= 5 AND (levenshtein({0}, {1}) <= 1 OR (length({0}) = length({1}) AND array_sort(split({0}, '')) = array_sort(split({1}, ''))))".replace("5", str(LONG))


def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """x, y, member: the pairs whose similarity reaches ``THRESHOLD``, computed exactly, and whose differing words are the same.

    A wording and the representative it is read as are member and class. Of two representatives the words left
    over on both sides must be within one edit each (of a doubtful slip half its letters, five edits at most), or have
    the same letters (words written together or parted), or be within half their letters where one side's are all doubtful."""
    cols = ["key", "target", "company", "words", "rare", "rep"]
    left, right = (nodes.select(F.col("id").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in cols]) for c in ("x", "y"))
    p = pairs.join(left, "x").join(right, "y")
    first = [f"get(company_{c}, 0)" for c in "xy"]
    p = p.filter(f"({first[0]} = {first[1]} OR {NEAR_NAME.format(*first)}) AND {_COMPANY.format('company_x', 'company_y')}")
    # names that are only near: the further words must be the same, or else the title's words
    p = p.filter(f"{first[0]} = {first[1]} OR (size(company_x) > 1 AND slice(company_x, 2, 99) = slice(company_y, 2, 99)) OR (least(size(company_x), size(company_y)) = 1 AND words_x = words_y)")
    p = p.withColumn("member", F.expr("target_x = key_y")).filter("member OR rep_x")
    p = once(p, "r", F.struct(F.array_except("words_x", "words_y").alias("u"), F.array_except("words_y", "words_x").alias("v")))
    u, v = "array_join(r.u, '')", "array_join(r.v, '')"
    letters = "array_join(array_sort(split({}, '')), '')"
    near = _NEAR.format("a", "b")
    # word by word: one edit, or more where either is doubtful
    pair = "({0} OR (({1}) AND levenshtein(a, b) <= greatest(2, least(5, length(a) DIV 2))))"
    near = pair.format(_NEAR.format("a", "b"), "array_contains(rare_x, a) OR array_contains(rare_y, b)")
    back = pair.format(_NEAR.format("a", "b"), "array_contains(rare_y, a) OR array_contains(rare_x, b)")
    each = f"(size(r.u) > 0 AND size(r.u) = size(r.v) AND forall(r.u, a -> exists(r.v, b -> {near})) AND forall(r.v, a -> exists(r.u, b -> {back})))"
    one = "(size({0}) = 1 AND forall({1}, w -> contains(get({0}, 0), w)))"
    together = f"({letters.format(u)} = {letters.format(v)} AND ({u} = {v} OR {one.format('r.u', 'r.v')} OR {one.format('r.v', 'r.u')}))"
    close = f"(levenshtein({u}, {v}) <= greatest(2, least(5, length({u}) DIV 2)) OR {letters.format(u)} = {letters.format(v)})"
    doubt = f"(size(r.u) > 0 AND size(r.v) > 0 AND {close} AND (size(array_except(r.u, rare_x)) = 0 OR size(array_except(r.v, rare_y)) = 0))"
    p = p.filter(f"member OR {together} OR {each} OR {doubt}")
    p = once(p.select("x", "y", "member", shingles(F.col("words_x")).alias("gx"), shingles(F.col("words_y")).alias("gy")), "both", F.size(F.array_intersect("gx", "gy")))
    return p.filter(_similar("gx", "gy")).select("x", "y", "member")


def doubtful(words: DataFrame) -> DataFrame:
    """word: of ``words`` (word, n: wordings that have it) those near or containing a word of far more wordings.

    Near is one edit (or the same letters) from a word of ``RATIO`` times as many wordings, or two (of seven letters
    and more also a swap and an edit) from one of ``FAR_RATIO`` times as many, or beginning or ending with such a word
    and three letters more (words written together). Only ratios count, so that a slip is
    as doubtful in a large table as in a small one, and Water and Waste are two words in either."""
    long = _spread(words.filter("length(word) >= 3"), "word").selectExpr("word", "n", f"explode({_deletions('word', '2')}) AS v")
    right = long.filter(F.col("n") >= RATIO).selectExpr("word AS target", "n AS often", "v")
    met = long.hint("merge").join(right, "v").filter(F.col("often") >= RATIO * F.col("n")).select("word", "n", "target", "often").distinct()
    d = F.expr("IF(array_sort(split(word, '')) = array_sort(split(target, '')), 1, levenshtein(word, target))")
    far = (F.col("often") >= FAR_RATIO * F.col("n")) & (d <= F.when(F.length("word") >= 7, 3).otherwise(2))
    ends = "flatten(transform(sequence(4, length(word) - 3), i -> array(substring(word, 1, i), substring(word, -i))))"
    parts = words.filter(F.length("word") >= 7).selectExpr("word", "n", f"explode({ends}) AS target")
    together = parts.join(words.select(F.col("word").alias("target"), F.col("n").alias("often")), "target").filter(F.col("often") >= FAR_RATIO * F.col("n"))
    return met.filter((d <= 1) | far).select("word").unionByName(together.select("word")).distinct()


def _key(words: str) -> Column:
    """128 bits of a wording: company, rank and words."""
    return F.unhex(F.md5(F.concat_ws("\x01", F.array_join("company", " "), "rank", F.array_join(words, " "))))


def _nodes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """id, key, target, rep, company, rank, words, read, rare: every wording once, and every representative, also one that nobody typed.

    ``target`` is the key of the representative that a wording is read as, and ``read`` are its words; representatives
    are their own and have no ``read``. ``rare`` are a representative's doubtful words."""
    none = F.array().cast("array<string>")
    typed, read = (F.struct(F.col(k).alias("key"), F.col("class_key").alias("target"), F.col(w).alias("words"), r.alias("read"), d.alias("doubt")) for k, w, r, d in (("raw_key", "raw", F.col("words"), none), ("class_key", "words", none, F.col("doubt"))))
    # a wording that is read as itself is its representative
    both = F.when(F.col("raw_key") == F.col("class_key"), F.array(read)).otherwise(F.array(typed, read))
    each = rows.select("company", "rank", F.explode(both).alias("n")).select("company", "rank", "n.*")
    nodes = each.groupBy("key").agg(F.max(F.struct(F.col("key") == F.col("target"), "target", "words", "read", "doubt")).alias("n"), F.first("company").alias("company"), F.first("rank").alias("rank"))
    return scratch.keep(nodes.select(F.monotonically_increasing_id().alias("id"), "key", "n.target", F.expr("key = n.target").alias("rep"), "company", "rank", "n.words", "n.read", "n.doubt"))


def _with_rare(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``nodes`` with ``rare`` in place of ``doubt``: a representative's words that are doubtful by themselves or among all."""
    words = nodes.filter("rep").select("id", F.explode("words").alias("word"))
    counted = scratch.keep(words.groupBy("word").agg(F.count("*").alias("n")))
    seen = scratch.keep(doubtful(counted))
    rare = words.join(seen, "word").groupBy("id").agg(F.collect_set("word").alias("more"))
    out = scratch.keep(nodes.join(rare, "id", "left").withColumn("rare", F.array_union("doubt", F.coalesce("more", F.array().cast("array<string>")))).drop("doubt", "more"))
    scratch.drop(nodes, counted, seen)
    return out


def openings(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (posting_id, class_id, town) and links (a, b; a < b) between the classes that are the same opening.

    Both together are the whole result: two postings advertise the same opening if they are of one class or of
    linked classes, and their towns do not differ (``TOWNS``). Each step's table is dropped after its last use."""
    spark = postings.sparkSession
    ship_package(spark)
    with Scratch(spark) as scratch:
        typed = scratch.keep(typed_words(postings.select("posting_id", "title", "company", "location_raw")))
        fixed = scratch.keep(corrections(typed, scratch.keep))
        rows = scratch.keep(canonical(typed, fixed).withColumns({"raw_key": _key("raw"), "class_key": _key("words")}))
        scratch.drop(typed, fixed)
        nodes = _nodes(rows, scratch)
        places = scratch.keep(rows.select("posting_id", "raw_key", "town"))
        scratch.drop(rows)
        nodes = _with_rare(nodes, scratch)
        joined = scratch.keep(nodes.join(reached(nodes), "id").select(F.col("key").alias("raw_key"), F.col("target").alias("found")))
        same = scratch.keep(verified(candidates(nodes, scratch), nodes.filter("rep")))
        # wordings that did not reach their representative are classes of their own
        members = places.join(joined, "raw_key", "left").select("posting_id", F.hex(F.coalesce("found", "raw_key")).alias("class_id"), "town").distinct()
        ends = same.join(nodes.select(F.col("id").alias("x"), F.col("key").alias("kx")), "x").join(nodes.select(F.col("id").alias("y"), F.col("key").alias("ky")), "y")
        links = ends.select(F.hex(F.least("kx", "ky")).alias("a"), F.hex(F.greatest("kx", "ky")).alias("b")).distinct()
        with shuffles_dropped(spark):
            return cut_lineage(members.select("*")), cut_lineage(links.select("*"))


#: SQL: whether two towns may be one; none, where it is not told, counts neither for nor against.
TOWNS = "ta = '' OR tb = '' OR ta = tb OR levenshtein(ta, tb, 2) BETWEEN 0 AND 1"


def same_openings(postings: DataFrame) -> DataFrame:
    """posting_id_a, posting_id_b (the smaller first): all pairs of postings of the same opening, distinct.

    Postings without company (null or blank) belong to no pair; a town that is null or not told counts neither
    for nor against. Rows delivered twice count once; an empty table gives no pairs."""
    members, links = openings(postings)
    several = members.groupBy("class_id").count().filter("count > 1").select(F.col("class_id").alias("a"), F.col("class_id").alias("b"))
    left = members.select(F.col("class_id").alias("a"), F.col("posting_id").alias("pa"), F.col("town").alias("ta"))
    right = members.select(F.col("class_id").alias("b"), F.col("posting_id").alias("pb"), F.col("town").alias("tb"))
    pairs = links.unionByName(several).join(left, "a").join(right, "b").filter("pa <> pb").filter(TOWNS)
    return pairs.select(F.least("pa", "pb").alias("posting_id_a"), F.greatest("pa", "pb").alias("posting_id_b")).distinct()


def opening_classes(postings: DataFrame) -> DataFrame:
    """posting_id, class_id, town, n_links: the class and town of each posting that has a company, and how many other classes are the same opening."""
    members, links = openings(postings)
    ends = links.select(F.col("a").alias("class_id")).unionByName(links.select(F.col("b").alias("class_id")))
    return members.join(ends.groupBy("class_id").agg(F.count("*").alias("n_links")), "class_id", "left").select("posting_id", "class_id", "town", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def opening_links(postings: DataFrame) -> DataFrame:
    """a, b (a < b): the pairs of classes of ``opening_classes`` that are the same opening."""
    return openings(postings)[1]
