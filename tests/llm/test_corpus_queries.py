"""The registered corpus queries beside their SQL, and the pipeline beside brute force, on the smallest tables."""

import collections
import hashlib
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import decontaminate, encoding, near_dedup, oracles, quality_model, queries
from tidemark.session import materialize

from .test_dedup_tokens import brute_components, brute_repeats
from .test_text_operators import brute_extended

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no benchmark tables here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_all_are_registered():
    names = {f"op{n}" for n in range(1, 14)}
    assert {q.split("_")[0] for q in queries.queries()} == names
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(oracles.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_agrees_with_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_byte_repeats_of_the_table(spark, docs):
    got = queries.queries()["op3_suffix_dedup"](spark, SF).collect()
    want = brute_repeats([(i, r["text"]) for i, r in docs.items()], 50)
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = queries.queries()["op5_quality_model"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_pipeline_matches_brute_force_stage_by_stage(spark, docs):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    machine = quality_model.train(given, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {}
    for i, r in docs.items():
        ids, values = quality_model.features(r["text"], r["n_chars"], machine.config)
        if machine.scores(ids, values, np.array([0]))[0] >= corpus_pipeline.KEPT_SCORE:
            want[i] = r["text"]
    frame, seen = given, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = materialize(stage(spark, frame, SF))
        assert frame.columns == list(corpus_pipeline.COLUMNS)
        if name == "line dedup":
            gone = brute_extended(list(want.items()), 8)
            want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ())) for i, t in want.items()}
        if name == "near dedup":
            of = brute_components([*want.items(), *((i, docs[i]["text"]) for i in want)], 5)
            want = {i: t for i, t in want.items() if of[i] == i}
        if name == "decontamination":
            config = decontaminate.AlignConfig()
            items = [decontaminate.tokens(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            block = decontaminate.Items(list(enumerate(items)), config)
            clean = {}
            for i, t in want.items():
                words = block.numbers(decontaminate.tokens(t))
                if all(decontaminate.aligned(x, words, config)[0] < config.least * config.match * len(x) for _, x in block.items):
                    clean[i] = t
            want = clean
        got = {r["doc_id"]: r["text"] for r in frame.collect()}
        assert got == want, name
        seen.append(len(got))
    assert seen[0] < len(docs) and seen[2] < seen[1]
    tokenizer = encoding.load(corpus_pipeline.VOCABULARY)
    rows = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    for r in rows:
        ids = np.array(tokenizer.encode(want[r["doc_id"]], add_special_tokens=False).ids, "<u4")
        assert bytes(r["ids"]) == ids.tobytes() and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
    assert len(rows) == len(want)


def test_a_copy_with_a_short_last_line_leaves_no_text(spark):
    body = "\n".join(f"line {k} of a document that is copied whole, with words enough" for k in range(4))
    copied = [(i, f"{body}\n{end}") for i, end in ((1, "Shth ndti."), (2, "Shth ndti."), (3, "Shth ndti."))]
    rows = [(i, t, "en", "s", len(t)) for i, t in [*copied, (9, "another document, which has nothing of the others in it")]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        frame = materialize(stage(spark, frame, SF))
        assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in frame.collect() if r["text"]} == {i: (t, n) for i, t, _, _, n in rows if i in (1, 9)}, name
    tokens = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()}
    assert tokens[1] > 0 and tokens[9] > 0 and tokens[2] == tokens[3] == 0


def test_near_copies_go_though_line_dedup_took_what_they_share(spark, tmp_path):
    lines = [" ".join(f"line{k}word{j}" for j in range(12)) for k in range(20)]
    near = [*lines[:9], lines[9].replace("word5", "edited"), *lines[10:]]
    far = [*lines[:10], *(" ".join(f"other{k}word{j}" for j in range(12)) for k in range(10))]
    rows = [(i, "\n".join(x), "en", "s", 1) for i, x in ((1, lines), (2, near), (3, far), (4, lines))]
    rows.append((None, rows[0][1], "en", "s", 1))
    given = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    given.write.parquet(f"{tmp_path}/documents.parquet")
    cleaned = materialize(corpus_pipeline.drop_lines(spark, given, str(tmp_path)))
    left = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    alone = near_dedup.near_duplicates(cleaned).filter("kept").select("doc_id").collect()
    assert 2 in {r["doc_id"] for r in alone}
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_copies(spark, cleaned, str(tmp_path)).collect()}
    assert {i for i in got if i is not None} == {1, 3}
    assert all(got[i] == left[i] for i in got)
    changed = corpus_pipeline.as_given(cleaned.filter("doc_id is not null"), given)
    assert {r["doc_id"] for r in changed.collect()} == {i for i, t in left.items() if i is not None and t != rows[i - 1][1]}
    assert corpus_pipeline.as_given(cleaned.limit(0), given).count() == 0


def test_one_row_of_each_group_stays_without_ids_too(spark):
    texts = {name: " ".join(f"{name}{k}" for k in range(120)) for name in "abcde"}
    near = texts["a"].replace("a60 ", "edited ")
    given = [(1, "a"), (1, "a"), (2, "a"), (None, "a"), (3, "b"), (3, "b"), (None, "c"), (None, "c"), (None, "d"), (4, "e"), (4, "d")]
    rows = [(i, texts[t]) for i, t in given] + [(None, near), (None, texts["c"].replace("c60 ", "edited ")), (5, None), (5, None), (None, None), (None, ""), (6, ""), (7, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.drop_copies(spark, frame.repartition(3), SF)
    assert got.columns == list(corpus_pipeline.COLUMNS)
    left = [(r["doc_id"], r["text"]) for r in got.collect()]
    c = [x for x in left if x[0] is None and x[1] and x[1].startswith("c0 ")]
    assert len(c) == 1
    want = [(1, texts["a"]), (3, texts["b"]), (4, texts["d"]), (4, texts["e"]), (5, None), (6, ""), (7, ""), (None, None), (None, "")]
    assert sorted((x for x in left if x not in c), key=str) == sorted(want, key=str)
    assert corpus_pipeline.drop_copies(spark, frame.limit(0), SF).count() == 0


def test_token_queries_agree_with_the_library_over_the_table(spark, docs):
    got = {r["doc_id"]: r for r in queries.queries()["op9_token_store"](spark, SF).collect()}
    tokenizer, start = encoding.load(queries.BYTE_LEVEL), 0
    for i in sorted(docs):
        ids = np.array([*tokenizer.encode(docs[i]["text"] or "", add_special_tokens=False).ids, queries.END_ID], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    tokenizer = encoding.load(queries.WORDS)
    for r in queries.queries()["op10_bpe"](spark, SF).collect():
        ids = tokenizer.encode(docs[r["doc_id"]]["text"] or "", add_special_tokens=False).ids
        said = tokenizer.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want
    assert len(got) == len(docs)


def test_quality_measures_agree_with_counting_over_the_table(spark, docs):
    for r in queries.queries()["op7_quality_rules"](spark, SF).collect():
        text = docs[r["doc_id"]]["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words)) and not (r["base_failed"] and r["kept"])
