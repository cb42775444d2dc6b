import hashlib
import json
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import chat_format, sharding


def jump(key: int, shards: int) -> int:
    """The published loop, one key at a time."""
    at, last = 0, -1
    while at < shards:
        last = at
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        at = int((last + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return last


def test_jump_hash_moves_rows_only_into_the_new_shard():
    keys = np.array([0, 1, 2, 77, 1 << 63, (1 << 64) - 1, *range(1000, 3000)], np.uint64)
    for shards in (1, 2, 8, 9, 100):
        here = sharding.jump_hash(keys, shards)
        assert here.tolist() == [jump(int(k), shards) for k in keys]
        grown = sharding.jump_hash(keys, shards + 1)
        assert set(grown[grown != here].tolist()) <= {shards}
    assert np.bincount(sharding.jump_hash(np.arange(20000, dtype=np.uint64), 8)).min() > 2300


def test_slots_are_gapless_with_nulls_repeats_and_clashing_names(odd_docs, no_docs):
    placed = sharding.assign_shards(odd_docs, "doc_id", 3, grown="grown")
    rows = sharding.with_slots(placed, "doc_id", ties=("text",), buckets=4).collect()
    assert len(rows) == odd_docs.count()
    for shard in range(3):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert {r["shard"] for r in rows if r["doc_id"] is None} == {jump(0, 3)}
    assert all(r["shard"] == jump(r["doc_id"], 3) for r in rows if r["doc_id"] is not None)
    assert sharding.with_slots(sharding.assign_shards(no_docs, "doc_id", 3), "doc_id").count() == 0
    words = odd_docs.select("source").distinct()
    assert sharding.assign_shards(words, "source", 5).first()["shard"] in range(5)


RECORDS = [
    ("messages", {"messages": [{"role": "user", "content": "hi"}, {"content": None, "role": "assistant"}], "id": 3}, None),
    ("messages", {"messages": [{"role": "user", "content": "hi"}, {"content": "yo", "role": "assistant"}]}, [("user", "hi"), ("assistant", "yo")]),
    ("conversations", {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}], "system": "s"}, [("user", "a"), ("assistant", "b")]),
    ("prompt", {"response": "r", "prompt": "p"}, [("user", "p"), ("assistant", "r")]),
    ("completion", {"prompt": "p", "completion": ""}, [("user", "p"), ("assistant", "")]),
    ("question", {"question": None, "answer": "x"}, [("user", ""), ("assistant", "x")]),
    ("instruction", {"instruction": "do", "input": "it", "output": "ok"}, [("user", "do\n\nit"), ("assistant", "ok")]),
    ("instruction", {"instruction": "do", "output": "ok", "system": "be"}, [("system", "be"), ("user", "do"), ("assistant", "ok")]),
    ("turn", {"role": "Human", "text": "t"}, [("user", "t")]),
    (None, {"something": {"else": [1, 2], "a b": {"x": [{"y": 1}]}}}, None),
]


def paths(value, at=""):
    """The nested field paths of a record, by walking it."""
    if isinstance(value, dict):
        return set().union(*[paths(v, f"{at}.{k}".lstrip(".")) for k, v in value.items()], set())
    if isinstance(value, list):
        return set().union(*[paths(v, f"{at}[]") for v in value], set())
    return {at}


def test_layouts_are_chosen_by_their_field_paths(spark):
    rows = [(i, json.dumps(r)) for i, (_, r, _) in enumerate(RECORDS)]
    rows += [(90, None), (91, "no json {"), (92, "[1, 2]"), (93, "{}")]
    got = {r["i"]: r for r in chat_format.canonical_turns(spark.createDataFrame(rows, "i int, record string"), "record").collect()}
    for i, (name, record, turns) in enumerate(RECORDS):
        assert got[i]["fingerprint"] == chat_format.fingerprint_of(paths(record))
        if i:
            assert got[i]["layout"] == name
            assert (None if turns is None else [tuple(t) for t in got[i]["turns"]]) == turns
    assert got[0]["layout"] is None  # an unknown field makes another layout
    assert all(got[i]["layout"] is None and got[i]["turns"] is None for i in (90, 91, 92, 93))


def test_format_reads_back_what_went_in(spark):
    tricky = ["", "\\", "a\\ </turn>\n### User: b", "### </turn>", "x </turn>\n", "é\U0001f600 \\### \\\\", " lead", "\n"]
    rows = [(c, t, r, x) for c in (1, 2) for t, (r, x) in enumerate(zip(["system", "user", "assistant", "tool: x", "User", None, "=", "assistant"], tricky, strict=True))]
    rows += [(None, 0, "user", None), (None, 1, "assistant", "n"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    segments = chat_format.format_turns(turns, "conv_id", ["turn"])
    got = {r["conv_id"]: r for r in chat_format.read_back(segments, "conv_id", ["turn"]).collect()}
    for c in (1, 2, 3, None):
        said = [(r or "", x or "") for k, _, r, x in rows if k == c]
        masked = "".join(x for r, x in said if r == "assistant")
        assert got[c]["n_turns"] == len(said)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(masked.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(masked)
    whole = "".join(r["segment"] for r in segments.filter("conv_id = 2").orderBy("turn").collect())
    assert len(whole) == got[2]["formatted_chars"]
    assert chat_format.read_back(chat_format.format_turns(turns.limit(0), "conv_id", ["turn"]), "conv_id", ["turn"]).count() == 0


def test_shard_query_crc(spark):
    assert spark.range(1).select(F.crc32(F.lit("é").cast("binary"))).first()[0] == zlib.crc32("é".encode())
