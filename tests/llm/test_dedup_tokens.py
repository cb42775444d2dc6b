"""Near-duplicates, byte repeats, token files and BPE against brute force and the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark import session
from tidemark.llm import bpe, encoding, near_dedup, suffix_array, suffix_dedup, token_store


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(docs, n, percent=80):
    """Smallest reachable id of every id, over all pairs."""
    sets = {}
    for i, t in docs:
        sets.setdefault(i, []).append(shingles(t, n))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def near_copies(drawn, base, share):
    return " ".join(w if drawn.random() > share else f"new{drawn.randrange(10**6)}" for w in base)


def test_components_match_brute_force(spark, odd_docs, no_docs):
    drawn = random.Random(11)
    docs = [(i, " ".join(f"w{drawn.randrange(3000)}" for _ in range(60))) for i in range(60)]
    for g in range(6):
        base = [f"g{g}x{k}" for k in range(120)]
        docs += [(1000 * (g + 1) + i, near_copies(drawn, base, drawn.choice((0.0, 0.01, 0.02, 0.03, 0.05)))) for i in range(30)]
    docs += [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] is not None]
    frame = spark.createDataFrame([*docs, (None, "a row without an id"), (None, docs[0][1])], "doc_id bigint, text string")
    for config in (near_dedup.NearConfig(), near_dedup.NearConfig(words=4)):
        want = brute_components(docs, config.words)
        got = near_dedup.near_duplicates(frame, config).collect()
        assert len(got) == len(docs) + 2
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    by_text = {(i, len(shingles(t, 4))) for i, t in docs}
    assert {(r["doc_id"], r["n_shingles"]) for r in got if r["doc_id"] is not None} == by_text
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_blocks_unite_what_brute_force_unites():
    drawn = np.random.default_rng(8)
    for trial in range(60):
        base = drawn.integers(0, 1 << 62, 100, np.uint64)
        sets = []
        for _ in range(int(drawn.integers(1, 150))):
            fresh = drawn.integers(0, 1 << 62, int(drawn.choice((0, 9, 11, 12, 25))), np.uint64)
            sets.append(np.unique(np.concatenate((drawn.permutation(base)[: 100 - len(fresh)], fresh))))
        start = drawn.integers(0, len(sets), len(sets))
        apart = drawn.random(len(sets)) < (1.0, 0.4)[trial % 2]
        label = start.copy()
        for i in np.flatnonzero(apart):
            for j in range(len(sets)):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    label[label == label[j]] = label[i]
        got, links = start.copy(), near_dedup.spanning_links(sets, start, apart, 80)
        for i, j in links:
            common = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common) and got[i] != got[j]
            got[got == got[j]] = got[i]
        assert len({*zip(got.tolist(), label.tolist(), strict=True)}) == len(set(got.tolist())) == len(set(label.tolist()))
        assert len(links) < len(sets)


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_heads_of_several_blocks_lose_no_link(spark, block):
    drawn = random.Random(21)
    sets = {i: np.array(sorted({*drawn.sample(range(60), 54), *(1000 * i + k for k in range(6))}), np.uint64) for i in range(1, 40)}
    apart = {i: drawn.random() < 0.5 for i in sets}
    parts = lambda ids: -(-sum(len(sets[i]) for i in ids) // block)
    sizes = (parts(sets), parts([i for i in sets if apart[i]]))
    active = spark.createDataFrame([(0, i, apart[i], i, *sizes) for i in sets], "head bigint, b bigint, apart boolean, component bigint, all_parts bigint, apart_parts bigint")
    full = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "id bigint, shingles binary")
    links = [tuple(r) for r in near_dedup._spanning(active, full, near_dedup.NearConfig(percent=75)).collect()]
    want, got = {i: i for i in sets}, {i: i for i in sets}

    def unite(of, a, b):
        p, q = sorted((of[a], of[b]))
        of.update({i: p for i in of if of[i] == q})

    for i in sets:
        for j in sets:
            common = len(np.intersect1d(sets[i], sets[j]))
            if apart[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                unite(want, i, j)
    for a, b in links:
        unite(got, a, b)
    assert got == want and len(set(want.values())) < len(sets)


def test_bayes_keeps_true_pairs_and_drops_far_ones():
    steps = near_dedup.least_matches(near_dedup.NearConfig())
    assert [n for n, _ in steps] == list(range(16, 129, 16)) and steps[-1][1] > 60
    drawn = np.random.default_rng(5)
    alive = lambda rate: all((drawn.random((4000, 128)) < rate)[:, :n].sum(1).min() >= 0 for n, _ in steps)
    assert alive(0.8)
    same = drawn.random((20000, 128)) < 0.8
    far = drawn.random((20000, 128)) < 0.3
    kept = lambda x: np.logical_and.reduce([x[:, :n].sum(1) >= m for n, m in steps]).mean()
    assert kept(same) == 1.0 and kept(far) < 0.001


def test_chains_of_links_are_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (900, 800)]
    drawn = random.Random(1)
    drawn.shuffle(edges)
    got = dict(near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500, 502: 500, 900: 800, 800: 800}


def test_suffix_array_matches_sorting():
    drawn = random.Random(3)
    for _ in range(400):
        letters = drawn.choice((1, 2, 3, 200))
        x = np.array([drawn.randint(1, letters) for _ in range(drawn.randint(0, 70))], np.int64)
        assert suffix_array.suffix_array(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


def brute_repeats(docs, length):
    """(id, bytes, removed, spans, digest) of every row, with a table of all strings' first documents."""
    key = lambda i: -(1 << 63) if i is None else i
    first = {}
    for i, t in docs:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            s = raw[k : k + length]
            first[s] = min(first.get(s, 1 << 63), key(i))
    out = []
    for i, t in docs:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < key(i):
                gone[k : k + length] = b"\x01" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("split", [128, 1])
def test_byte_repeats_match_brute_force(spark, odd_docs, no_docs, split):
    drawn = random.Random(7)
    parts = ["".join(drawn.choice("abcdé ") for _ in range(drawn.choice((20, 40, 49, 50, 51, 90, 200)))) for _ in range(14)]
    docs = []
    for i in range(160):
        text = "".join(drawn.choice(parts) if drawn.random() < 0.6 else "".join(drawn.choice("xyz") for _ in range(30)) for _ in range(4))
        docs.append((i, text if drawn.random() < 0.9 else None))
    docs += [(1000 + i, "ab" * 60 + str(i % 3)) for i in range(12)] + [(50, docs[3][1]), (2, docs[9][1])]
    docs += [(r["doc_id"], (r["text"] or "")[:3000]) for r in odd_docs.collect()]
    config = suffix_dedup.RepeatConfig(unit_bytes=3000, stretch_bytes=700, bucket_units=2, sort_bytes=2000, split_units=split)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = suffix_dedup.without_repeats(frame, config).collect()
    rows = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got]
    assert sorted(rows, key=str) == sorted(brute_repeats(docs, 50), key=str)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert suffix_dedup.without_repeats(no_docs).count() == 0


def test_byte_repeats_shuffle_no_text_and_few_digests(spark, monkeypatch):
    """Whole texts were joined with their twins by an exchange at size; copies of a split snippet were digested once a block."""
    drawn = random.Random(11)
    passage = "".join(drawn.choice("abcdefg ") for _ in range(400))
    texts = ["".join(drawn.choice("stuvwxyz ") for _ in range(200)) + f"{i:04}" + passage for i in range(128)]
    docs = [*enumerate(texts), (500, texts[7]), (501, texts[7]), (-3, texts[9]), (502, "short"), (503, "short"), (None, texts[20])]
    kept = []
    monkeypatch.setattr(suffix_dedup, "materialize", lambda df, made=suffix_dedup.materialize: kept.append(made(df)) or kept[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
        config = suffix_dedup.RepeatConfig(unit_bytes=1500, bucket_units=8, block_units=4, split_units=1)
        found = suffix_dedup.without_repeats(frame, config)
        rows = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found.collect()]
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(rows, key=str) == sorted(brute_repeats(docs, 50), key=str)
    digests = next(df for df in kept if "digest" in df.columns).filter("digest is not null")
    # the passage's own windows, and those of each text around its beginning
    assert digests.count() < 40 * len(texts)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(frame):
    """Bytes of the largest batch that a Python worker gets of a frame."""

    def sizes(batches):
        for batch in batches:
            yield batch.from_pydict({"size": [batch.nbytes]})

    return frame.mapInArrow(sizes, "size bigint").agg({"size": "max"}).first()[0]


def test_long_units_reach_readers_and_workers_a_few_at_once(spark, monkeypatch):
    """All units of a task were one row group and one Arrow batch, in several copies outside the heap."""
    stored = []
    write = suffix_dedup.materialize_long_rows
    monkeypatch.setattr(suffix_dedup, "materialize_long_rows", lambda df, n: stored.append(write(df, n)) or stored[-1])
    spark.conf.unset(BATCH)
    docs = spark.range(0, 60, 1, 1).selectExpr("id as doc_id", "repeat(concat(id, ' '), 300000 div length(concat(id, ' '))) as text")
    assert suffix_dedup.without_repeats(docs).count() == 60
    (units,) = stored
    (file,) = [f.removeprefix("file:") for f in units.inputFiles()]
    groups = pq.ParquetFile(file).metadata
    assert max(groups.row_group(i).num_rows for i in range(groups.num_row_groups)) <= suffix_dedup.UNITS_AT_ONCE
    assert largest_batch(units) < 6_000_000


def test_a_smaller_batch_that_the_session_names_stays(spark):
    try:
        for named, kept in (("64k", "64k"), ("64m", "4194304b")):
            spark.conf.set(BATCH, named)
            session.bounded_batches(spark)
            assert spark.conf.get(BATCH) == kept
    finally:
        spark.conf.unset(BATCH)


def test_anchors_spread_evenly_over_buckets():
    """Anchors are least hashes of their windows; a bucket of the smallest held fourteen times its share."""
    text = np.random.default_rng(3).integers(97, 123, 400_000).astype(np.uint8)
    anchors = suffix_dedup.owned_windows(text, np.array([len(text)]), 50).anchor
    held = np.bincount((anchors >> np.uint64(56)).astype(int), minlength=256)
    assert held.max() < 2 * held.mean()


WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


def odd_texts():
    drawn = random.Random(2)
    made = []
    for _ in range(150):
        base = list("".join(drawn.choice("abcdefghi") for _ in range(drawn.randint(0, 400))))
        for _ in range(drawn.randint(0, 12)):
            base.insert(drawn.randrange(len(base) + 1), drawn.choice(["'re", "'S", " ", "\n", "  ", " \n", "<|endoftext|>", "12", "!!", "é", "́", "İ", "漢字", "\x1c", "\x00", "\t"]))
        made.append("".join(base))
    return made


def test_units_encode_as_whole_texts():
    for name, dtype, units in ((WORDS, "<u4", encoding.word_units), (BYTES, "<u2", encoding.byte_level_units)):
        whole, own = encoding.load(name), encoding.UnitEncoder(name, dtype)
        for text in odd_texts():
            assert np.frombuffer(own.encode(units(text)), dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_tree_of_halves_is_the_whole():
    whole = encoding.load(WORDS)
    for k, text in enumerate(odd_texts()):
        assert bpe.encode_whole(text, WORDS, (8, 20, 50)[k % 3]) == whole.encode(text, add_special_tokens=False).ids


def test_bpe_round_trip_over_rows(spark, odd_docs, no_docs):
    tokenizer = encoding.load(WORDS)
    for size in (1000, bpe.STRETCH):
        got = bpe.encode_documents(odd_docs, WORDS, size=size).withColumn("again", bpe.decoded(bpe.F.col("ids"), WORDS)).collect()
        want = []
        for r in odd_docs.collect():
            ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False)))
        assert sorted([(r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in got], key=str) == sorted(want, key=str)
        assert all(r["again"] == r["decoded"] for r in got)
    assert bpe.encode_documents(no_docs, WORDS).count() == 0


def test_documents_reach_the_encoder_in_bounded_batches(spark):
    """A batch was up to 64 MB of text, twice outside the heap of an executor for each of its tasks."""
    docs = spark.range(0, 100, 1, 1).selectExpr("id as doc_id", "repeat('word ', 30000) as text")
    spark.conf.unset(BATCH)
    encoded = bpe.encode_documents(docs, WORDS)
    assert largest_batch(docs) < 6_000_000
    assert encoded.count() == 100


def test_a_cut_at_white_space_needs_no_models_of_pieces():
    """Every worker that cut a text loaded the vocabulary four times, 70 MB for a moment."""
    own = bpe.Joiner(WORDS)
    text = "some words of it " * 4000
    ends = [0, *[at for at, _ in own.cuts(text, 1000)], len(text)]
    parts = [own.stretch(text[a:b], False, False) for a, b in zip(ends, ends[1:], strict=False)]
    assert own.tree(parts, [False] * (len(parts) - 1)).ids == encoding.load(WORDS).encode(text, add_special_tokens=False).ids
    assert "pieces" not in vars(own) and own.tokenizer is own.units.tokenizer


def test_perfect_hash_is_minimal_and_knows_strangers():
    keys = token_store.key_hash(np.arange(-500, 20000), np.zeros(20500, np.int64))
    made = token_store.PerfectHash.build(keys)
    assert sorted(made.find(keys).tolist()) == list(range(len(keys)))
    index = token_store.Index(token_store.pack_index(keys, np.arange(20500) % 7, np.arange(20500) * 3, np.arange(20500) % 11))
    entries, there = index.look_up(keys)
    assert there.all() and entries["offset"].tolist() == (np.arange(20500) * 3).tolist()
    strangers = token_store.key_hash(np.arange(10**6, 10**6 + 5000), np.zeros(5000, np.int64))
    assert index.look_up(strangers)[1].sum() <= 1
    empty = token_store.Index(token_store.pack_index(keys[:0], keys[:0], keys[:0], keys[:0]))
    assert not empty.look_up(keys[:3])[1].any()


def test_store_reads_back_every_row(spark, odd_docs, no_docs, tmp_path, monkeypatch):
    tokenizer = encoding.load(BYTES)
    monkeypatch.setattr(token_store, "SHARD_ROWS", 4)
    monkeypatch.setattr(token_store, "INDEX_KEYS", 5)
    for frame, name in ((odd_docs, "a"), (no_docs, "b")):
        root = f"file://{tmp_path}/{name}"
        manifest = token_store.write_store(token_store.encoded(frame, BYTES, 0), frame.select("doc_id"), root)
        parts = token_store.write_index(manifest, root)
        places = token_store.look_up(manifest, root, parts)
        got = token_store.with_starts(token_store.read_digests(places, root), manifest).orderBy("start").collect()
        want = []
        for r in frame.collect():
            ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
            want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        assert sorted([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got], key=str) == sorted(want, key=str)
        assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()[: len(got)]
        assert [r["doc_id"] is None for r in got] == sorted([r["doc_id"] is None for r in got], reverse=True)
        known = [r["doc_id"] for r in got if r["doc_id"] is not None]
        assert known == sorted(known)
    asked = spark.createDataFrame([(10**9, 0), (6, 0)], "doc_id bigint, copy bigint")
    root = f"file://{tmp_path}/a"
    assert [r["doc_id"] for r in token_store.look_up(asked, root, 4).collect()] == [6]
