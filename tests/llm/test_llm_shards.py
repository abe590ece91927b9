"""Shards against a search over all groups in plain Python."""

import random
import zlib

import edge
import pytest
from twinsieve.llm import shards


def smallest_capacity(sizes, count):
    def needed(capacity):
        n, room = 1, capacity
        for size in sizes:
            if size > room:
                n, room = n + 1, capacity
            room -= size
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= count else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_minimax(spark, workspace, seed, monkeypatch):
    monkeypatch.setattr(shards, "FIRST_BITS", 3)
    monkeypatch.setattr(shards, "SPLIT_BITS", 2)
    pick = random.Random(seed)
    keys = sorted(pick.sample(range(1 << 60), 60) + [pick.randrange(100) for _ in range(40)])
    groups = [(k, pick.choice([1, 5, 50, 1000])) for k in dict.fromkeys(keys)]
    frame = workspace.stage(spark.createDataFrame(groups, "key bigint, size bigint"), "groups")
    cuts = shards.cuts(frame, 7)
    loads = [0] * 7
    for key, size in groups:
        loads[sum(key > c for c in cuts)] += size
    assert max(loads) == smallest_capacity([s for _, s in groups], 7)


def check(frame, rows, count=16):
    got = frame.collect()
    assert len(got) == len(rows)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots))) and 0 <= shard < count
    texts = {}
    for text, row in zip([r[1] for r in rows], [None] * len(rows), strict=True):
        data = (text or "").encode()
        texts.setdefault((len(data) + 1, zlib.crc32(data)), text)
    assert {(r["size"], r["text_crc32"]) for r in got} == set(texts)
    places = {}
    for r in got:
        places.setdefault((r["size"], r["text_crc32"], r["doc_id"]), set()).add(r["shard"])
    assert all(len(v) == 1 for v in places.values())
    return got


def test_edge_rows(spark, workspace):
    frame = edge.clashing(spark, "size", "key", "shard", "place")
    got = check(shards.sharded(frame, workspace), edge.ROWS)
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    assert shards.sharded(edge.empty(spark), workspace).count() == 0


def test_equal_texts_stay_together(spark, workspace, monkeypatch):
    monkeypatch.setattr(shards, "SLOT_ROWS", 50)
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = check(shards.sharded(frame, workspace), rows)
    assert len({r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"copy")}) == 1
