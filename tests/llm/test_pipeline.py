import hashlib
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_texts import check_packing, water_fill
from tidyforge.llm.queries import QUERIES, fold
from tidyforge.llm.toxicity import score_toxicity

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).parents[2]


def plain_mix(rows):
    """(doc_id, words taken) of (doc_id, source, text) rows, with plain dictionaries."""
    sized = [(i, s, len(brute.words(t))) for i, s, t in rows]
    totals = Counter()
    for _, s, n in sized:
        totals[s] += n
    taken = {}
    for s, target in water_fill(totals).items():
        budget = int(target + 0.5)
        epochs, rest = divmod(budget, totals[s]) if totals[s] else (0, 0)
        own = sorted((int(hashlib.md5(f"{'' if i is None else i}:{n}".encode()).hexdigest()[:15], 16), i, n)
                     for i, source, n in sized if source == s)
        for _, i, n in own:
            part = max(0, min(n, rest))
            rest -= n
            taken[i] = epochs * n + part
    return taken


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage, run one after the other."""
    docs, held = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        held.append((docs, after))
        docs = after
    return held


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard", "substring_dedup", "source_mixing", "packing"]
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes and 0 < after.count()


def test_toxic_documents_go(spark, stages):
    before, after = stages[0]
    scored = score_toxicity(before, spark.read.parquet(f"{FOLDER}/labels.parquet"), fold() != 0)
    want = {r["doc_id"]: r["text"] for r in scored.where("score < 0.5").collect()}
    assert {i: r["text"] for i, r in rows_of(after).items()} == want and len(want) < before.count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    clean = [i for i in rows_of(before) if labels.get(i) == 0]
    assert sum(i in want for i in clean) >= 0.98 * len(clean)


def test_one_of_each_group_stays(stages):
    before, after = (rows_of(df) for df in stages[1])
    want = {i for i, _, c in brute.jaccard_components([(i, r["text"]) for i, r in before.items()]) if i == c}
    assert after.keys() == want and all(after[i] == before[i] for i in after)


def test_repeats_are_cut(stages):
    before, after = (rows_of(df) for df in stages[2])
    for i, _, gone, kept in brute.repeats_removed([(i, r["text"]) for i, r in before.items()]):
        assert after[i]["text"] == (kept if gone else before[i]["text"])
        assert after[i]["n_chars"] == len(after[i]["text"])


def test_sources_are_mixed(stages):
    before, after = stages[3]
    taken = plain_mix([(r["doc_id"], r["source"], r["text"]) for r in before.collect()])
    got = Counter()
    for r in after.collect():
        got[r["doc_id"]] += len(brute.words(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert +got == +Counter(taken)


def test_pieces_cover_the_mix(stages):
    before, after = stages[4]
    rows = after.collect()
    check_packing(rows)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, got = Counter(), Counter()
    texts = {}
    for r in before.collect():
        ids = own.encode(r["text"], add_special_tokens=False).ids + [1]
        want[r["doc_id"], len(ids)] += len(ids)
        texts.setdefault((r["doc_id"], len(ids)), ids)
    for r in rows:
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
        part = texts[r["doc_id"], r["doc_tokens"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    assert got == want


def test_run_is_the_stages_in_a_row(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    want = stages[-1][1]
    assert got.columns == want.columns
    assert got.agg(F.sum("length"), F.count_distinct("doc_id")).first() == want.agg(
        F.sum("length"), F.count_distinct("doc_id")).first()


def test_stages_with_odd_rows(spark):
    rows = [(i, t, "en", None if i % 4 == 0 else f"s{i % 3}", None if t is None else len(t))
            for i, t in enumerate(brute.ODD_TEXTS)]
    rows += [rows[5], (None, "no id here at all", "en", "s1", 17), (None, "no id here at all", "en", "s1", 17),
             (None, "another text without an id", None, None, None)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    kept = corpus_pipeline.one_of_each_group(spark, docs, FOLDER)
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert max(got.values()) == 1 and got[None, "no id here at all"] == 1
    assert got[None, "another text without an id"] == 1 and len({i for i, _ in got}) < len(rows)
    for source in (docs, docs.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, source, FOLDER)
            assert out.count() >= 0 if source is docs else out.count() == 0


def test_rows_that_share_an_id_are_told_apart(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "xyz")
    rows = [(7, one), (7, two), (7, two), (9, one), (3, two), (-4, three), (None, three + " more"), (None, None),
            (None, "..."), (None, "!"), (None, "a lost text of some words")]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows],
                                 spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    for source in (docs, docs.repartition(5)):
        kept = corpus_pipeline.one_of_each_group(spark, source, FOLDER)
        assert kept.dtypes == docs.dtypes
        assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
            [(7, one), (3, two), (-4, three), (None, None), (None, "..."), (None, "!"), rows[-1]])


def test_queries_return_the_columns_of_their_contracts(spark):
    want = {
        "op1": "doc_id held_out score predicted", "op2": "query_id rank vec_id score",
        "op3": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op4": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op5": "doc_id size source_size target taken", "op6": "vec_id n_links component_id kept",
        "op7": "page_id url text n_chars", "op8": "doc_id n_shingles component_id",
        "op9": "doc_id n_words n_removed kept_sha256",
        "op10": "page_id payload_bytes payload_digest record_type refers_to",
        "op11": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
        "op12": "doc_id size text_crc32 law shard slot grown_shard",
        "op13": "doc_id leaf subroot root proof_sha256 folded_root verified"}
    assert [re.match("op[0-9]+", n)[0] for n in QUERIES] == list(want)
    longs = {"start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_tokens", "n_known",
             "train_tokens", "size", "taken", "n_links", "component_id", "n_chars", "n_shingles",
             "n_words", "n_removed", "payload_bytes", "vec_id", "query_id", "conv_id", "gaps", "blank",
             "duplicate", "truncated", "illegal", "cost", "text_crc32", "slot"}
    for name, query in QUERIES.items():
        df = query(spark, FOLDER)
        assert df.columns == want[re.match("op[0-9]+", name)[0]].split()
        kinds = dict(df.dtypes)
        assert all(kinds[c] == "bigint" for c in longs & set(kinds)), (name, kinds)


def test_library_works_without_the_package(tmp_path):
    import shutil
    for name in ("tidyforge", "catalog", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()))"],
                          cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    assert "flagship" in told and "op1" not in told and "pipeline" not in told
    for path in (ROOT / "tidyforge").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tidyforge.llm" not in path.read_text()
