"""Problem 2: deeply nested records as flat tables that keep parent and child linked.

Method: Merkle subtree identities. Every object at any depth is canonicalised and hashed bottom-up, its hash covering its
own members and the hashes and places of its children. Identical objects are stored once (``objects``); where they hang is
kept by bridge rows (parent, path, ordinal, child), and where trees begin by ``occurrences``. From these three every
record can be put together again (``restored`` does so for tests). The flat tables are read by following the bridges from the
occurrences of jobs, each distinct job once.

Trees of any depth are beyond the built-in functions, so records are walked in Arrow batches, each on its own. A frequent
identity (an empty tier, the one department of a large board) is combined before it is shuffled; the join from jobs to
their occurrences carries a salt taken from the envelope (``SALTS`` shares of one identity).
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.runtime import cut_lineage, ship_package

#: Bytes of the SHA-256 that identify an object: 128 bits, for which equal identities of different objects are out of reach.
DIGEST = 16
#: Shares into which the occurrences of one identity are split for joins.
SALTS = 16
#: Of each board the kinds of children of a job: name, way from the job, member that describes it, and kinds of its own.
KINDS = {
    "board_notion": (("tier", ("compensation", "compensationTiers"), "tierSummary", (("component", ("components",), "componentType", ()),)),),
    "board_intercom": (("office", ("offices",), "location", ()), ("department", ("departments",), "name", ())),
}

_NODE = pa.struct([("hash", pa.binary()), ("own", pa.string())])
_LINK = pa.struct([("parent", pa.binary()), ("path", pa.string()), ("ordinal", pa.int32()), ("child", pa.binary())])
_KID = pa.struct([("child", pa.string()), ("child_no", pa.int32()), ("component_no", pa.int32()), ("item", pa.string())])
_JOB = pa.struct([("no", pa.int32()), ("hash", pa.binary()), ("kids", pa.list_(_KID))])
_TREE = pa.schema([("board", pa.string()), ("envelope_id", pa.int64()), ("root", pa.binary()), ("jobs", pa.list_(_JOB)), ("nodes", pa.list_(_NODE)), ("links", pa.list_(_LINK))])
_TREE_SQL = (
    "board string, envelope_id bigint, root binary, jobs array<struct<no int, hash binary, kids array<struct<child string, child_no int, component_no int, item string>>>>, "
    "nodes array<struct<hash binary, own string>>, links array<struct<parent binary, path string, ordinal int, child binary>>"
)


def _refuse(name: str):
    raise ValueError(name)


def _number(text: str) -> float | str:
    """A number, or its text where it is beyond all doubles."""
    x = float(text)
    return x if math.isfinite(x) else text


_READ = json.JSONDecoder(parse_constant=_refuse, parse_float=_number).decode


def read(text: str | None):
    """What a text says as JSON; None where it is null, no complete document (as when it was cut off) or nested beyond reading."""
    try:
        return _READ(text) if text else None
    except (ValueError, RecursionError):
        return None


def unwrapped(v):
    """``v``, or what it says where it is a text that holds a JSON object or array."""
    if isinstance(v, str) and v.lstrip(" \t\r\n")[:1] in ("{", "["):
        found = read(v)
        return v if found is None else found
    return v


def told(v) -> str:
    """A member's value as text, '' if missing or null."""
    return v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


class Tree:
    """The objects of one record by their hashes, and the links between them."""

    def __init__(self):
        self.own: dict[bytes, str] = {}
        self.members: dict[bytes, dict] = {}
        self.kids: dict[bytes, list[tuple[str, int, bytes]]] = {}

    def add(self, v: dict) -> bytes:
        """Store an object and all below it; children leave an empty object in their place among its own members."""
        kids: list[tuple[str, int, bytes]] = []

        def bare(x, path: str, ordinal: int):
            x = unwrapped(x)
            if isinstance(x, dict):
                kids.append((path, ordinal, self.add(x)))
                return {}
            if isinstance(x, list):
                below = path if ordinal < 0 else f"{path}/{ordinal}"
                return [bare(y, below, i) for i, y in enumerate(x)]
            return x

        own = json.dumps({k: bare(v[k], k, -1) for k in sorted(v)}, separators=(",", ":"))
        sha = hashlib.sha256(own.encode())
        for path, ordinal, child in kids:
            sha.update(b"\x01%s\x02%d\x02" % (path.encode("utf-8", "surrogatepass"), ordinal))
            sha.update(child)
        key = sha.digest()[:DIGEST]
        if key not in self.own:
            self.own[key], self.members[key], self.kids[key] = own, v, kids
        return key

    def below(self, key: bytes, way: tuple[str, ...]) -> Iterator[tuple[int, bytes]]:
        """Position and hash of the objects in the array (or in its place) at the end of ``way``; before it only objects lead on."""
        for path, ordinal, child in self.kids[key]:
            if path == way[0]:
                if len(way) == 1:
                    yield max(ordinal, 0), child
                elif ordinal < 0:
                    yield from self.below(child, way[1:])

    def flat(self, key: bytes, kinds: tuple) -> list[tuple[str, int, int, str]]:
        out = []
        for kind, way, item, inner in kinds:
            for no, child in self.below(key, way):
                out.append((kind, no, -1, told(self.members[child].get(item))))
                out += [(k, no, n, i) for k, n, _, i in self.flat(child, inner)]
        return out


def _clean(s: str) -> str:
    return s.encode("utf-8", "replace").decode()


def _walk(whole: bool):
    """A function over batches of board, envelope_id, text that gives the trees; ``whole`` with their nodes and links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in _TREE.names}
            for board, envelope, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                root = unwrapped(read(text))
                if not isinstance(root, dict):
                    continue
                tree = Tree()
                top = tree.add(root)
                jobs = [{"no": no, "hash": h, "kids": [{"child": k, "child_no": n, "component_no": c, "item": _clean(i)} for k, n, c, i in tree.flat(h, KINDS[board])]} for no, h in tree.below(top, ("jobs",))]
                out["board"].append(board)
                out["envelope_id"].append(envelope)
                out["root"].append(top)
                out["jobs"].append(jobs)
                out["nodes"].append([{"hash": h, "own": o} for h, o in tree.own.items()] if whole else [])
                out["links"].append([{"parent": h, "path": _clean(p), "ordinal": o, "child": c} for h, kids in tree.kids.items() for p, o, c in kids] if whole else [])
            yield pa.RecordBatch.from_pydict(out, schema=_TREE)

    return run


def board_trees(notion: DataFrame, intercom: DataFrame, whole: bool = True) -> DataFrame:
    """board, envelope_id, root, jobs (no, hash and flat children of each), nodes and links of every envelope of both kinds.

    Payloads that are null, cut off or no object have no tree. Other columns are never read. ``whole`` false leaves
    nodes and links empty, for what only needs the jobs."""
    ship_package(notion.sparkSession)
    texts = notion.select(F.lit("board_notion").alias("board"), "envelope_id", F.col("payload").alias("text"))
    rows = texts.unionByName(intercom.select(F.lit("board_intercom").alias("board"), "envelope_id", F.to_json(F.struct("jobs")).alias("text")))
    return rows.mapInArrow(_walk(whole), _TREE_SQL)


def _hex(c: str) -> Column:
    return F.lower(F.hex(c))


def occurrences(trees: DataFrame) -> DataFrame:
    """board, envelope_id, hash (hex): the topmost object of each envelope; a redelivered envelope counts once."""
    return trees.select("board", "envelope_id", "root").distinct().select("board", "envelope_id", _hex("root").alias("hash"))


def objects(trees: DataFrame) -> DataFrame:
    """hash (hex), own: every distinct object once, with its own members as JSON in the order of their names, children as ``{}``."""
    return trees.select(F.explode("nodes").alias("n")).groupBy("n.hash").agg(F.first("n.own").alias("own")).select(_hex("hash").alias("hash"), "own")


def bridge(trees: DataFrame) -> DataFrame:
    """parent_hash, child_hash (hex), path, ordinal: the children of every distinct object.

    ``path`` is the member's name, for arrays within arrays followed by the outer positions; ``ordinal`` the position in
    the array, -1 for an object that stands in none."""
    links = trees.select(F.explode("links").alias("l")).select("l.*").distinct()
    return links.select(_hex("parent").alias("parent_hash"), _hex("child").alias("child_hash"), "path", "ordinal")


def flat_children(trees: DataFrame) -> DataFrame:
    """board, envelope_id, job_no, child, child_no, component_no, item: one row per child object.

    Positions count from 0 in the arrays as delivered; ``component_no`` is -1 but for components, whose
    ``child_no`` is their tier's. Rows are distinct; empty tables give none. Trees are walked once and written."""
    salt = F.pmod(F.xxhash64("envelope_id"), F.lit(SALTS)).cast("int")
    jobs = cut_lineage(trees.select("board", "envelope_id", salt.alias("salt"), F.explode("jobs").alias("j")).filter(F.size("j.kids") > 0))
    occur = jobs.select("board", "envelope_id", "salt", F.col("j.no").alias("job_no"), F.col("j.hash").alias("hash"))
    # a distinct job's children are kept once per salt
    store = jobs.groupBy("j.hash", "salt", "board").agg(F.first("j.kids").alias("kids"))
    flat = occur.join(store, ["hash", "salt", "board"]).select("board", "envelope_id", "job_no", F.inline("kids"))
    return flat.distinct()


def restored(key: str, own: dict[str, str], links: dict[str, list[tuple[str, int, str]]]):
    """A record put together again from the rows of ``objects`` and ``bridge``; for small tables and tests."""
    below = {(path, ordinal): child for path, ordinal, child in links.get(key, [])}

    def whole(x, path: str, ordinal: int):
        if isinstance(x, dict):
            return restored(below[path, ordinal], own, links)
        if isinstance(x, list):
            inner = path if ordinal < 0 else f"{path}/{ordinal}"
            return [whole(y, inner, i) for i, y in enumerate(x)]
        return x

    return {k: whole(v, k, -1) for k, v in json.loads(own[key]).items()}
