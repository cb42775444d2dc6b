"""Rules, classifier, decontamination and line runs against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from tidemark.llm import decontaminate, line_dedup, quality_model, quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    text = text or ""
    w = WORD.findall(text)
    counts = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {p for k in range(len(w) - 2) if counts[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark, odd_docs, no_docs):
    drawn = random.Random(5)
    made = ["".join(drawn.choice(["a", "b", " ", "\n", "\x0b", "#", "é", " "]) for _ in range(drawn.randint(0, 200))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(made)] + [(100 + i, r["text"]) for i, r in enumerate(odd_docs.collect())]
    got = quality_rules.text_measures(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    by_id = {r["doc_id"]: r for r in got}
    for i, text in rows:
        r = by_id[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_measures(text)
    assert quality_rules.judged(quality_rules.text_measures(no_docs)).count() == 0
    assert len(got) == len(rows)


def test_label_model_finds_the_rule_that_errs():
    drawn = np.random.default_rng(3)
    truth = np.where(drawn.random(20000) < 0.6, 1, -1)
    rates = (0.95, 0.9, 0.7)
    votes = [np.where(drawn.random(20000) < a, truth, -truth) * (drawn.random(20000) < 0.8) for a in rates]
    patterns = collections.Counter(zip(*[v.tolist() for v in votes], strict=True))
    model = quality_rules.fit_label_model(list(patterns.items()), 3)
    assert np.allclose(model.accuracies, rates, atol=0.03)
    assert model == quality_rules.fit_label_model(list(reversed(patterns.items())), 3)
    assert quality_rules.fit_label_model([], 2).accuracies == (quality_rules.START,) * 2


def test_good_texts_stay_and_junk_goes(spark):
    good = ". ".join(f"the cat{i} sat{i} on a mat{i} and o{i} was as happy{i} as{i} in may{i}" for i in range(12))
    junk = " ".join(f"word{i}### other{i}$$$" for i in range(60))
    shout = " ".join(f"LOUD{i}!! NOISE{i}!!" for i in range(60))
    docs = spark.createDataFrame([(1, good), (2, junk), (3, shout), (4, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in quality_rules.judged(quality_rules.text_measures(docs)).collect()}
    assert got[1]["quality_posterior"] > 0.5 > got[2]["quality_posterior"]
    assert not got[3]["kept"] and got[4]["base_failed"] and not got[4]["kept"]


def test_pairwise_sum_is_the_square_identity():
    config = quality_model.MachineConfig(buckets=16, factors=3)
    drawn = np.random.default_rng(1)
    size = config.buckets + quality_model.N_STATISTIC_FEATURES
    machine = quality_model.Machine(0.3, drawn.normal(size=size).astype(np.float32), drawn.normal(size=(size, 3)).astype(np.float32), config)
    ids, values = quality_model.features("some words and some more!", None, config)
    odds = machine.bias + float(machine.weights[ids] @ values)
    for a in range(len(ids)):
        for b in range(a):
            odds += float(machine.vectors[ids[a]] @ machine.vectors[ids[b]] * values[a] * values[b])
    assert machine.scores(ids, values, np.array([0]))[0] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-4)


def test_machine_learns_and_leaves_held_out_rows_alone(spark, odd_docs, no_docs):
    drawn = random.Random(2)
    text = lambda bad: " ".join(("#%&$ " if bad and drawn.random() < 0.5 else "") + drawn.choice("the of and moon sun river stone".split()) for _ in range(40))
    rows = [(i, text(i % 4 == 0), None if i % 7 == 0 else 200, i % 4 != 0) for i in range(400)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, n_chars bigint")
    labels = spark.createDataFrame([(r[0], int(r[3])) for r in rows] + [(None, 1), (3, None), (5, 9), (10**9, 0)], "doc_id bigint, quality int")
    got = quality_model.scored(docs, quality_model.train(docs, labels)).withColumn("out", quality_model.held_out()).collect()
    held = [r for r in got if r["out"]]
    assert len(held) > 40 and all((r["score"] >= 0.5) == (r["doc_id"] % 4 != 0) for r in held)
    flipped = spark.createDataFrame([(r["doc_id"], 1 - int(r["doc_id"] % 4 != 0)) for r in held], "doc_id bigint, quality int")
    only = labels.join(flipped.select("doc_id"), "doc_id", "left_anti")
    again = quality_model.scored(docs, quality_model.train(docs, only.unionByName(flipped))).collect()
    assert {r["doc_id"]: r["score"] for r in got} == {r["doc_id"]: r["score"] for r in again}
    blank = quality_model.train(no_docs, labels)
    scores = quality_model.scored(odd_docs, blank).collect()
    assert len(scores) == odd_docs.count() and all(r["score"] == pytest.approx(0.5) for r in scores)
    assert quality_model.scored(no_docs, blank).count() == 0


def test_alignment_matches_the_quadratic_recurrence():
    drawn = random.Random(9)
    config = decontaminate.AlignConfig()
    for _ in range(60):
        x = np.array([drawn.randint(1, 5) for _ in range(drawn.randint(1, 12))])
        y = np.array([drawn.randint(0, 5) for _ in range(drawn.randint(1, 20))])
        h = np.zeros((len(x) + 1, len(y) + 1), int)
        for i in range(1, len(x) + 1):
            for j in range(1, len(y) + 1):
                s = config.match if x[i - 1] == y[j - 1] else config.mismatch
                h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + config.gap, h[i, j - 1] + config.gap)
        score, first, last = decontaminate.aligned(x, y, config)
        assert score == h.max()
        if score:
            assert 0 <= first <= last < len(y) and x.tolist().count(y[last]) > 0


def test_copies_are_found_whole_edited_and_by_the_thousand(spark, no_docs):
    drawn = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda n: [drawn.choice(vocabulary) for _ in range(n)]
    items = [(i, words(30)) for i in range(12)]
    docs, planted = [], set()
    for i in range(120):
        body = words(80)
        if i % 3 == 0:
            item, copy = items[i % 12][0], list(items[i % 12][1])
            if i % 2:
                for k in range(4, 30, 8):
                    copy[k] = "edited"
                copy.insert(13, "inserted")
            body[40:40] = copy
            planted.add((i, item))
        docs.append((i, " ".join(body).upper() + "."))
    docs += [(1000 + i, "Before, " + " ".join(items[5][1]) + " after") for i in range(300)]
    planted |= {(1000 + i, 5) for i in range(300)}
    docs += [(None, " ".join(items[2][1])), (5000, None), (5001, "")]
    planted.add((None, 2))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(90, None), (91, ""), (92, "zebra quagga")], "item_id bigint, text string")
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for block in (10**6, 50):
        got = decontaminate.copies(frame, bench, decontaminate.AlignConfig(block_words=block)).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == planted
    assert decontaminate.without_copies(frame, bench).count() == len(docs) - len(planted)
    short = spark.createDataFrame([(1, "a zebra quagga here"), (2, "zebra and quagga")], "doc_id bigint, text string")
    assert [(r["doc_id"], r["item_id"], r["score"]) for r in decontaminate.copies(short, bench).collect() if r["item_id"] == 92 and r["score"] == 1.0] == [(1, 92, 1.0)]
    assert decontaminate.copies(no_docs, bench).count() == 0 and decontaminate.copies(frame, bench.limit(0)).count() == 0


def brute_extended(docs, words):
    """Which lines of each distinct (id, text) lie in a run of `words` words that occurs earlier, runs extended to their ends."""
    keyed = sorted({(i, t) for i, t in docs if t}, key=lambda d: (d[0] is not None, d[0] or 0))
    split = [[(k, x, len(WORD.findall(x))) for k, x in enumerate(t.split("\n")) if WORD.search(x)] for _, t in keyed]
    gone = collections.defaultdict(set)
    for d, (key, here) in enumerate(zip(keyed, split, strict=True)):
        for e, there in enumerate(split[: d + 1]):
            for diagonal in range(1 - len(here), len(there) if e < d else 0):
                run = []
                for p in range(max(0, -diagonal), len(here) + 1):
                    q = p + diagonal
                    if p < len(here) and q < len(there) and here[p][1] == there[q][1]:
                        run.append(here[p])
                        continue
                    if sum(n for _, _, n in run) >= words:
                        gone[key] |= set(range(run[0][0], run[-1][0] + 1))
                    run = []
    return gone


def test_extended_runs_match_brute_force(spark, odd_docs, no_docs):
    drawn = random.Random(12)
    pool = [" ".join(f"{drawn.choice('abcdefgh')}{k}" for _ in range(drawn.choice((0, 1, 2, 3, 4, 7)))) for k in range(20)]
    long = [" ".join(f"long{k}x{i}" for i in range(8 + k)) for k in range(6)]
    docs = [(i, "\n".join(drawn.choice(pool) for _ in range(drawn.randint(0, 12)))) for i in range(60)]
    for i in range(60):
        lines = [drawn.choice(long if drawn.random() < 0.4 else pool[:8]) for _ in range(drawn.randint(0, 9))]
        docs.append((100 + i, "\n".join(x for x in lines if x)))
    a, b, c = "a run of just ten words begins right at this", "three words more", "and then four words"
    tails = [(900, f"{a}\n{b}\nother words"), (901, f"{a}\n{b}\n{c}"), (902, f"before it\n{a}\n{b}\n{c}"), (903, f"{a}\n{b}\n{c}\nends otherwise")]
    docs += [*tails, (None, docs[5][1]), (500, docs[3][1]), (500, docs[3][1])]
    docs += [(2000 + r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] not in (None, 12)]
    got = line_dedup.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string"), 8).collect()
    gone = brute_extended(docs, 8)
    want = collections.Counter()
    for i, t in docs:
        lines = gone.get((i, t), set())
        want[i, t if not lines else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lines), len(lines)] += 1
    assert collections.Counter((r["doc_id"], r["text"], r["removed_lines"]) for r in got) == want
    by_id = {r["doc_id"]: (r["text"], r["removed_lines"], r["removed_runs"]) for r in got}
    assert [by_id[i] for i in range(900, 904)] == [(tails[0][1], 0, 0), (c, 2, 1), ("before it", 3, 1), ("ends otherwise", 3, 1)]
    assert line_dedup.without_repeats(no_docs).count() == 0
    kept = line_dedup.without_repeats(odd_docs.withColumnRenamed("slot", "removed_runs"))
    assert kept.count() == odd_docs.count() and kept.columns.count("removed_runs") == 1


def test_line_query_leaves_nothing_of_a_copy_with_a_short_end(spark, tmp_path):
    text = "a copied line has more than eight words in it\nshort end"
    spark.createDataFrame([(1, text), (2, text)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op2_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(1, text, 0, 0), (2, "", 2, 1)]


def test_a_long_exact_part_of_an_item_is_a_copy(spark):
    drawn = random.Random(6)
    words = lambda n, kind: [f"{kind}{drawn.randrange(10**6)}" for _ in range(n)]
    item = words(59, "i")
    docs = [
        (1, " ".join(words(40, "d") + item[20:49] + words(40, "d"))),
        (2, " ".join(words(40, "d") + item[:13])),
        (3, " ".join(words(40, "d") + item[46:] + words(9, "d"))),
        (4, " ".join(words(40, "d") + item[20:32] + words(40, "d"))),
        (5, " ".join(words(90, "d"))),
        (6, " ".join(words(20, "d") + item)),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    got = {r["doc_id"]: (r["points"], r["first_word"], r["last_word"]) for r in decontaminate.copies(frame, bench).collect()}
    assert got == {1: (58, 40, 68), 2: (26, 40, 52), 3: (26, 40, 52), 6: (118, 20, 78)}
    assert {r["doc_id"] for r in decontaminate.without_copies(frame, bench).collect()} == {4, 5}
