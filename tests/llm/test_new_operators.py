"""Fill-in-the-middle, vector codes and source mixing beside brute force, on the cases every operator must stand."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle, line_dedup, mixing, quality_model, quality_rules, sharding, vector_codes
from tidemark.session import materialize

FIM = fill_middle.FimConfig()


def plain_fim(key, text, config):
    """(form, output, prefix, middle) by slicing and joining."""
    lines = text.split("\n")
    lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    h = hashlib.sha256(f"{config.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in (config.prefix, config.suffix, config.middle)) or h3 % 100 >= config.share:
        return "plain", text, None, None, n
    if h4 % 100 < config.spm:
        return "spm", f"{config.suffix}{suffix}{config.prefix}{prefix}{config.middle}{middle}", len(prefix), len(middle), n
    return "psm", f"{config.prefix}{prefix}{config.suffix}{suffix}{config.middle}{middle}", len(prefix), len(middle), n


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_rotation_exchanges_blocks(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    drawn = random.Random(block)
    for _ in range(200):
        raw = bytes(drawn.randrange(256) for _ in range(drawn.randrange(40)))
        a, b, c = sorted(drawn.randint(0, len(raw)) for _ in range(3))
        buffer = bytearray(raw)
        fill_middle.rotate(buffer, a, b, c)
        assert bytes(buffer) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]
        fill_middle.rotate(buffer, a, a + c - b, c)
        assert bytes(buffer) == raw


def test_texts_take_their_form_and_come_back():
    drawn = random.Random(3)
    forms = collections.Counter()
    for i in range(1500):
        text = "".join(drawn.choice(["\n", "a", "é", "<", "P>", "<P", "\U0001f600", "S", "\r", "M>", " "]) for _ in range(drawn.randrange(30)))
        config = drawn.choice([FIM, fill_middle.FimConfig(share=50, spm=20), fill_middle.FimConfig(prefix="<|pre|>", suffix="<|suf|>", middle="<|mid|>")])
        made = fill_middle.transformed(text.encode(), str(i), config)
        assert (made.form, made.output.decode(), made.prefix_chars, made.middle_chars, made.lines) == plain_fim(i, text, config)
        assert fill_middle.restored_text(made.output, made.form, config).decode() == text
        forms[made.form] += 1
    assert min(forms.values()) > 100
    for wrong in ({"prefix": ""}, {"prefix": "<S>"}, {"middle": "a<"}):
        with pytest.raises(ValueError, match="sentinels"):
            fill_middle.FimConfig(**wrong)


def test_fill_in_middle_of_odd_tables(spark, odd_docs, no_docs):
    clashing = odd_docs.withColumns({"key": F.lit(1), "output": F.lit("x"), "FORM": F.lit("y"), "restored": F.lit(2), "_text": F.lit("z")})
    made = fill_middle.fill_in_middle(clashing)
    assert made.columns == [*odd_docs.columns, "key", "restored", "_text", "n_lines", "form", "output", "prefix_chars", "middle_chars"]
    rows = fill_middle.restored(made).collect()
    assert len(rows) == odd_docs.count() and {(r["key"], r["_text"], r["slot"]) for r in rows} == {(1, "z", 3)}
    for r in rows:
        text = r["text"] or ""
        want = plain_fim("" if r["doc_id"] is None else r["doc_id"], text, FIM)
        assert (r["form"], r["output"], r["prefix_chars"], r["middle_chars"], r["n_lines"]) == want and r["restored"] == text
    assert fill_middle.restored(fill_middle.fill_in_middle(no_docs)).count() == 0
    assert fill_middle.restored(made.withColumn("form", F.lit(None).cast("string"))).filter("restored is not null").count() == 0


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and codebooks by comparing everything, with whole numbers of Python."""
    kept = sorted(((i, [int(np.floor(256 * x)) for x in v]) for i, v in rows), key=lambda r: (r[0] is None, r[0] or 0))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for _, v in kept:
                groups[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    out = []
    for i, v in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, books


@pytest.fixture(scope="module")
def vectors():
    """Clusters, so that bounds hold; ties, repeats and large steps between rounds among them."""
    drawn = np.random.default_rng(5)
    centres = drawn.normal(0, 1, (12, 32))
    made = (centres[drawn.integers(0, 12, 260)] + drawn.normal(0, 0.02, (260, 32))).astype(np.float32)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(drawn.permutation(260), made, strict=True)]
    return rows + [(300, rows[0][1]), (300, rows[0][1]), (301, [0.0] * 32), (302, [-5000.0 / 2] * 32), (None, rows[7][1])]


def test_codes_are_those_of_comparing_everything(spark, vectors):
    frame = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id bigint, embedding array<float>, label int").repartition(3)
    for rounds, group in ((2, 4), (5, 3), (0, 16)):
        config = vector_codes.CodeConfig(parts=8, entries=20, rounds=rounds, group=group)
        made = vector_codes.compress(frame, config, carry=("label",))
        want, books = brute_codes(vectors, 8, 20, rounds)
        got = made.codes.collect()
        assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=str) == sorted(want, key=str)
        assert made.history[-1].tolist() == books and len(made.history) == rounds + 1
        assert made.digest() == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        assert all(r["label"] == 1 for r in got)
    config = vector_codes.CodeConfig(parts=8, entries=20, rounds=5)
    made = vector_codes.compress(frame, config)
    # most parts are settled by their bounds in the last round
    assert made.codes.agg(F.avg("compared")).first()[0] < 4
    back = {r["vec_id"]: r["decoded"] for r in vector_codes.decoded(made.codes, made.history[-1]).collect()}
    assert np.abs(np.array(back[301])).max() < 2 and len(back[301]) == 32


def test_net_displacement_is_tighter_than_the_sum_of_steps():
    drawn = np.random.default_rng(2)
    start = drawn.normal(0, 200, (1, 6, 4)).round().astype(np.int64)
    there = start + drawn.integers(-90, 90, start.shape)
    back = start + 1
    near = vector_codes.Assigner([start, there, back], 3)
    net = near.moved[0, 0]
    drift = np.sqrt(((there - start) ** 2).sum(-1))[0] + np.sqrt(((back - there) ** 2).sum(-1))[0]
    assert np.allclose(net, 2.0) and (net < drift).all()
    x = drawn.normal(0, 200, (500, 1, 4)).round()
    b = vector_codes.Bounds.none(500, 1, 2)
    vector_codes.Assigner([start], 3).assign(x, b)
    again = near.assign(x, b)
    want = ((x[:, None] - back[0]) ** 2).sum(-1).argmin(-1) if x.ndim == 2 else ((x - back.astype(float)) ** 2).sum(-1).argmin(-1)
    assert (b.code[:, 0] == want).all() and again.mean() < 0.2


def test_vectors_that_have_no_code(spark):
    good = [0.5, -0.25] * 16
    rows = [
        (1, good), (2, None), (3, [*good[:-1], None]), (4, [*good[:-1], float("nan")]), (5, [float("inf"), *good[1:]]), (6, []), (7, good[:16]),
        (8, [3.0e38, -3.0e38] * 16), (None, good), (1, good), (9, good[:31]),
    ]
    frame = spark.createDataFrame([(i, v, "c", b"w") for i, v in rows], "vec_id bigint, embedding array<float>, whole string, low binary")
    made = vector_codes.compress(frame, carry=("whole", "low"))
    got = made.codes.collect()
    assert sorted((str(r["vec_id"]), r["whole"], bytes(r["low"])) for r in got) == [("1", "c", b"w"), ("1", "c", b"w"), ("8", "c", b"w"), ("None", "c", b"w")]
    assert all(r["error"] == 0 for r in got) and made.history[-1].shape == (16, 4, 2)
    empty = vector_codes.compress(frame.limit(0))
    assert empty.codes.collect() == [] and empty.codes.columns == ["vec_id", "code", "error", "compared"]
    assert empty.digest() == hashlib.sha256(b"").hexdigest()


def plain_targets(sizes, weights, most=3):
    """Share by weight, stop at the limit, share the excess anew among the others."""
    target, total = {}, sum(sizes.values())
    while True:
        left = total - sum(target.values())
        open_ = {s: w for s, w in weights.items() if s not in target and w > 0}
        over = {s for s, w in open_.items() if w * left > most * sizes[s] * sum(open_.values())}
        if not over:
            return {s: float(target[s]) if s in target else (weights[s] * left / sum(open_.values()) if s in open_ else 0.0) for s in sizes}
        target |= {s: most * sizes[s] for s in over}


def test_targets_stop_and_are_shared_anew(spark):
    drawn = random.Random(4)
    for case in range(12):
        n = drawn.randint(1, 9)
        sizes = {f"s{i}": drawn.choice([0, 1, drawn.randint(1, 50), drawn.randint(1000, 90000)]) for i in range(n)}
        weights = {s: drawn.choice([0, 1, 2, 5, 40]) if case else 1 for s in sizes}
        frame = spark.createDataFrame([(s, sizes[s], weights[s]) for s in sizes], "source string, source_size bigint, weight bigint")
        got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
        assert got == pytest.approx(plain_targets(sizes, weights), abs=1e-6)
    odd = spark.createDataFrame([("a", 10, None), ("b", 10, -3), (None, 10, 1)], "source string, source_size bigint, weight bigint")
    assert {r["source"]: r["target"] for r in mixing.source_targets(odd).collect()} == {"a": 0.0, "b": 0.0, None: 30.0}
    assert mixing.source_targets(odd.limit(0)).count() == 0


def test_the_mix_comes_near_its_targets(spark):
    drawn = random.Random(9)
    docs = [(i, drawn.choice(["web", "web", "web", "books", "é", None]), " ".join("w" * drawn.randint(1, 60))) for i in range(6000)]
    docs += [(None, "web", "no id"), (7, "web", "again"), (7, "web", "again"), (9001, "none", None), (9002, "none", ""), (9003, "none", " \n\t")]
    frame = spark.createDataFrame(docs, "doc_id bigint, source string, text string").withColumns({"copies": F.lit("x"), "source_of": F.lit(5), "Size": F.lit(1)}).repartition(5)
    plan = mixing.mix_plan(frame, (5, 2, 1))
    rows = plan.collect()
    assert sorted(plan.columns) == sorted(["doc_id", "source", "text", "source_of", "size", "source_size", "target", "copies"])
    assert len(rows) == len(docs) and all(r["copies"] <= 3 for r in rows)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert r["size"] == len((r["text"] or "").split())
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    order = [*sorted(s for s in sizes if s is not None), None]
    assert order == ["books", "none", "web", "é", None]
    assert target == pytest.approx(plain_targets(sizes, dict(zip(order, (5, 2, 1, 5, 2), strict=True))))
    for s in sizes:
        more = target[s] / sizes[s] % 1 if sizes[s] else 0.0
        spread = sum(r["size"] ** 2 for r in rows if r["source"] == s) * more * (1 - more)
        assert abs(taken[s] - target[s]) <= 4 * spread**0.5 + 1e-6
    assert {r["doc_id"]: r["copies"] for r in rows} == {r["doc_id"]: r["copies"] for r in mixing.mix_plan(frame.repartition(2), (5, 2, 1)).collect()}
    given = materialize(plan)
    mix = mixing.emitted(given).groupBy("doc_id", "text").agg(F.count("*").alias("n"), F.max("copy").alias("last")).collect()
    assert sum(r["n"] for r in mix) == sum(r["copies"] for r in rows) and "copies" not in mixing.emitted(given).columns
    assert {r["doc_id"] for r in mix} == {r["doc_id"] for r in rows if r["copies"]}
    assert mixing.mix_plan(frame.limit(0), (5, 2, 1)).count() == 0


#: Names that operators use for columns of their own.
TAKEN = [
    "_cell", "_row", "_before", "_n", "_key", "_id", "_cuts", "_words", "_text", "_lines", "_windows", "_sorted", "_placed", "n_words",
    "N_SYMBOLS", "key", "output", "form", "restored", "whole", "code_", "low", "own", "source_of", "size_", "row", "mark", "digest",
]


def _slots(df):
    return sharding.with_slots(sharding.assign_shards(df, "doc_id", 3, "shard_of", "grown_of"), "doc_id", "shard_of", "slot_of", ties=("text",))


@pytest.mark.parametrize(
    ("operator", "gone"),
    [
        (_slots, set()),
        (line_dedup.without_repeats, set()),
        (quality_rules.text_measures, {"text", "n_words", "N_SYMBOLS"}),
        (lambda df: quality_model.scored(df, quality_model.train(df.limit(0), df.select("doc_id", F.lit(1).alias("quality")).limit(0)), score="score_of"), set()),
        (lambda df: fill_middle.restored(fill_middle.fill_in_middle(df)), {"form", "output", "restored"}),
        (lambda df: mixing.mix_plan(df, (5, 2, 1)), set()),
    ],
    ids=["sharding", "line dedup", "quality rules", "quality model", "fill-in-middle", "mixing"],
)
def test_columns_of_the_callers_own_stay(odd_docs, no_docs, operator, gone):
    mine = {c: F.lit(f"mine {c}") for c in TAKEN}
    made = operator(odd_docs.withColumns(mine))
    kept = [c for c in TAKEN if c not in gone]
    assert set(kept) <= set(made.columns)
    rows = made.collect()
    assert len(rows) == odd_docs.count() and all(r[c] == f"mine {c}" for r in rows for c in kept)
    assert operator(no_docs.withColumns(mine)).count() == 0


def test_the_model_does_not_depend_on_the_order_of_repeated_ids(spark):
    texts = [(i % 40, f"text {i} " + "word " * (i % 17), 10 + i) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    schema = "doc_id bigint, text string, n_chars bigint"
    here = quality_model.train(spark.createDataFrame(texts, schema).repartition(2), labels)
    there = quality_model.train(spark.createDataFrame(texts[::-1], schema).repartition(5), labels)
    ids, values = quality_model.features("some text of words", 18, here.config)
    start = np.array([0])
    assert here.scores(ids, values, start) == there.scores(ids, values, start)
