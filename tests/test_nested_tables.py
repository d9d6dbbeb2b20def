"""Flat child tables against a plain walk, and the identities' properties."""

import json

from vacantia.operators import nested_tables as nt

OFFICE = "array<struct<id bigint, name string, location string>>"
INTERCOM = f"envelope_id bigint, jobs array<struct<id bigint, title string, absolute_url string, location struct<name string>, updated_at string, offices {OFFICE}, departments array<struct<id bigint, name string>>, content string>>, salt int, hash string"
TIER = {"tierSummary": "€10k", "components": [None, {"componentType": "Salary", "minValue": 1}, {"componentType": None}, 7]}
PAYLOADS = [
    {"jobs": [{"id": "a", "compensation": {"compensationTiers": [TIER, None, {"components": {"componentType": "Bonus"}}]}}, None, {"id": "b"}]},
    {"jobs": {"id": "c", "compensation": json.dumps({"compensationTiers": TIER})}},
    {"jobs": json.dumps([{"id": "d", "compensation": {"compensationTiers": json.dumps([json.dumps(TIER)])}}])},
    {"jobs": []}, {}, {"jobs": None}, {"jobs": [{"id": "e", "compensation": {"compensationTiers": "none"}}]}, [],
]


def unwrap(v):
    if isinstance(v, str) and v.strip()[:1] in ("[", "{"):
        try:
            return json.loads(v)
        except ValueError:
            return v
    return v


def items(v):
    v = unwrap(v)
    return [unwrap(x) for x in v] if isinstance(v, list) else [v] if isinstance(v, dict) else []


def brute(envelope, payload):
    out = set()
    root = unwrap(payload)
    for j, job in enumerate(items(root.get("jobs")) if isinstance(root, dict) else []):
        if not isinstance(job, dict):
            continue
        pay = unwrap(job.get("compensation"))
        for t, tier in enumerate(items(pay.get("compensationTiers")) if isinstance(pay, dict) else []):
            if not isinstance(tier, dict):
                continue
            out.add(("board_notion", envelope, j, "tier", t, -1, tier.get("tierSummary") or ""))
            for c, part in enumerate(items(tier.get("components"))):
                if isinstance(part, dict):
                    out.add(("board_notion", envelope, j, "component", t, c, part.get("componentType") or ""))
    return out


def trees(spark, payloads, boards):
    n = spark.createDataFrame(payloads, "envelope_id bigint, payload string, jobs string")
    return nt.board_trees(n, spark.createDataFrame(boards, INTERCOM))


def test_shapes(spark):
    rows = [(i, json.dumps(p), "x") for i, p in enumerate(PAYLOADS)]
    rows += rows[:3] + [(90, json.dumps(PAYLOADS[0])[:-5], "x"), (91, None, "x"), (92, "", "x")]
    job = (1, "t", "u", None, "d", [(1, "Hall", None), None, (2, None, "Rome")], [(3, "HR")], "c")
    boards = [(7, [job, None, job], 1, "h"), (8, None, 1, "h"), (9, [], 1, "h"), (10, [(None, None, None, None, None, None, [], None)], 1, "h")]
    t = trees(spark, rows, boards)
    got = [tuple(r) for r in nt.flat_children(t).collect()]
    want = set().union(*(brute(i, p) for i, p in enumerate(PAYLOADS)))
    for no in (0, 2):
        want |= {("board_intercom", 7, no, "office", 0, -1, ""), ("board_intercom", 7, no, "office", 2, -1, "Rome"), ("board_intercom", 7, no, "department", 0, -1, "HR")}
    assert len(got) == len(set(got)) and set(got) == want
    objects, bridge = nt.objects(t).collect(), nt.bridge(t).collect()
    own = {r["hash"]: r["own"] for r in objects}
    assert len(own) == len(objects)
    assert {r["child_hash"] for r in bridge} <= set(own) and {r["parent_hash"] for r in bridge} <= set(own)
    # the tier of payloads 0, 1 and 2 is stored once, and so is the office job that occurs twice
    assert sum("tierSummary" in o for o in own.values()) == 1 and sum('"absolute_url"' in o for o in own.values()) == 1
    links = {}
    for r in bridge:
        links.setdefault(r["parent_hash"], []).append((r["path"], r["ordinal"], r["child_hash"]))
    roots = {r["envelope_id"]: r["hash"] for r in nt.occurrences(t).collect() if r["board"] == "board_notion"}

    def plain(v):
        v = unwrap(v)
        return {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else [plain(x) for x in v] if isinstance(v, list) else v

    assert {i: nt.restored(h, own, links) for i, h in roots.items()} == {i: plain(p) for i, p in enumerate(PAYLOADS) if isinstance(p, dict)}


def test_member_order_and_positions(spark):
    a = {"jobs": [{"id": "a", "compensation": {"compensationTiers": [{"x": 1, "y": 2}]}}]}
    b = '{"jobs": [{"compensation": {"compensationTiers": [{"y": 2, "x": 1}]}, "id": "a"}]}'
    c = {"jobs": [{"id": "a", "compensation": {"compensationTiers": [None, {"x": 1, "y": 2}]}}]}
    t = trees(spark, [(1, json.dumps(a), ""), (2, b, ""), (3, json.dumps(c), "")], [])
    own = sorted(r["own"] for r in nt.objects(t).collect())
    assert own == ['{"compensation":{},"id":"a"}'] * 2 + ['{"compensationTiers":[null,{}]}', '{"compensationTiers":[{}]}'] + ['{"jobs":[{}]}'] * 2 + ['{"x":1,"y":2}']
    assert nt.occurrences(t).select("hash").distinct().count() == 2


def test_any_depth_and_odd_texts(spark):
    deep = {"jobs": [[{"a": [[{"b": {"c": [1, None, {"d": 2}]}}], {"e": "[1, 2"}]}], "x"], "odd": "\ud800", "long": "y" * 100_000}
    t = trees(spark, [(1, json.dumps(deep), ""), (2, '{"jobs": NaN}', ""), (3, "[" * 100_000, ""), (4, "7", ""), (None, "{}", "")], [])
    own, links = {r["hash"]: r["own"] for r in nt.objects(t).collect()}, {}
    for r in nt.bridge(t).collect():
        links.setdefault(r["parent_hash"], []).append((r["path"], r["ordinal"], r["child_hash"]))
    roots = {r["envelope_id"]: r["hash"] for r in nt.occurrences(t).collect()}
    assert set(roots) == {1, None} and nt.restored(roots[1], own, links) == deep
    assert {(p, o) for kids in links.values() for p, o, _ in kids} == {("jobs/0", 0), ("a/0", 0), ("a", 1), ("b", -1), ("c", 2)}
    assert nt.flat_children(t).count() == 0


def test_empty(spark):
    assert nt.flat_children(trees(spark, [], [])).count() == 0
