"""The registered queries and the pipeline on small tables, against plain computations of what their contracts fix."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from apportion.llm import langid, queries

from .test_text_operators import MODEL, plain_components, plain_spans, plain_tiles

KINDS = ("assign", "access", "hex")


def of(doc_id, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    tongues = {"aa": "the and ing of to in that was for", "bb": "der und die nicht ein ich schon aber", "cc": "ka mo ti ra su ne po lo"}
    out = []
    for i in range(240):
        lang = sorted(tongues)[i % 3]
        text = " ".join(r.choices(tongues[lang].split(), k=r.randint(12, 40)))
        if i % 10 == 0:
            text += f" token = {'Ab1' * 5} and AKIA{'A' * 16} 0123456789abcdef00"
        if i % 16 == 1:
            text = text + " benchmark item " + " ".join(f"q{k}" for k in range(12))
        out.append((i, text, None if i % 11 == 0 else lang, "s", len(text)))
    out += [(300 + k, out[k][1], out[k][2], "s", out[k][4]) for k in range(12)]
    return [*out, (400, None, None, "s", None), (401, "", "aa", "s", 0), (402, " \t1 2", "aa", "s", 5), (None, "der und die nicht", "bb", "s", 17)]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(0, 240, 2)] + [(1, None), (999, 1)], "doc_id long, quality int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(12))), (2, "no such words in any text at all")], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def collected(df):
    return sorted(df.collect(), key=lambda r: (str(r["doc_id"]), repr(r)))


def test_op1(spark, folder, rows):
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = collected(queries.op1_sentencepiece(spark, folder))
    assert all(r["round_trip"] for r in got)
    assert sorted((str(r["doc_id"]), r["n_pieces"]) for r in got) == sorted((str(i), len(sp.encode(t or ""))) for i, t, *_ in rows)


def test_op2(spark, folder, rows):
    got = queries.op2_simhash(spark, folder).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == plain_components([(i, t) for i, t, *_ in rows])


def test_op3(spark, folder, rows):
    got = {}
    for r in queries.op3_media(spark, folder).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t, *_ in rows:
        raw = (t or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        for r in got[i]:
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
            assert len(r["timestamps"]) >= 1 and r["timestamps"] == sorted(r["timestamps"]) and r["random_access"][0] == 0


def test_op4(spark, folder, rows):
    shared = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    got = {r["doc_id"]: r for r in queries.op4_secrets(spark, folder).collect()}
    for i, t, *_ in rows:
        spans = plain_spans(t or "")
        counts = Counter(k for _, k, _ in spans)
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts[k] for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert re.sub(r",?pem:\d+:\d+", "", r["spans"]).strip(",") == text
    assert not list(Path(shared).glob("secrets-*"))  # the query's own ledger is gone


def test_op6_and_op8(spark, folder, rows):
    got = queries.op6_quality(spark, folder).collect()
    assert sorted((str(r["doc_id"]), r["held_out"]) for r in got) == sorted((str(i), of(i, 3) == 1) for i, *_ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    got = queries.op8_language(spark, folder).collect()
    assert sorted((str(r["doc_id"]), r["held_out"]) for r in got) == sorted((str(i), of(i, 4) == 2) for i, *_ in rows)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {400, 401, 402}
    known = {i: lang for i, _, lang, *_ in rows if lang and i is not None and i < 300}
    right = [r["lang_pred"] == known[r["doc_id"]] for r in got if r["doc_id"] in known and r["held_out"]]
    assert sum(right) > 0.95 * len(right)


def test_foreign_text_is_rejected(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs)
    odd = spark.createDataFrame([(k, "".join(random.Random(k).choices("ЖШЩЫЭЮЯцчщ", k=60))) for k in range(30)], "doc_id long, text string")
    assert sum(r["rejected"] for r in langid.predict(odd, model).collect()) > 10


def test_op7(spark, folder, rows):
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontaminate(spark, folder).collect()}
    item = [f"q{k}" for k in range(12)]
    want = {(i, 1) for i, t, *_ in rows if plain_tiles((t or "").split(), item, 5) >= 0.8 * 12}
    assert got == want and want


def test_op10(spark, folder, rows):
    got = {}
    for r in queries.op10_lm_scores(spark, folder).collect():
        got.setdefault(r["doc_id"], []).append(r)
    tokens = [(i, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), "\n"]) for i, t, *_ in rows]
    counts = Counter(w for i, own in tokens if of(i, 5) != 1 for w in own)
    n, v = counts.total(), len(counts)
    for i, own in tokens:
        for r in got[i]:
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (of(i, 5) == 1, len(own), sum(counts[w] > 0 for w in own), n)
            assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), abs=1e-9)
            assert r["score"] < 0


def test_pipeline_is_its_stages_one_by_one(spark, folder, rows):
    """Each stage's decisions by a plain computation on what the one before kept."""
    sentencepiece = pytest.importorskip("sentencepiece")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.fit(docs.where("doc_id IS NULL OR crc32(cast(cast(doc_id AS string) AS binary)) % 4 != 2"))
    kept = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rejected = {str(r["doc_id"]) for r in langid.predict(docs, model).collect() if r["rejected"]}
    kept = [(i, t) for i, t in kept if str(i) not in rejected]
    assert len(kept) > 0.9 * len(rows)
    first = {}
    for i, _, component in plain_components(kept):
        first.setdefault(component, []).append(i)
    kept = [(i, t) for i, t in kept if str(i) in {min(v, key=lambda x: (x == "None", int(x) if x != "None" else 0)) for v in first.values()}]
    item = [f"q{k}" for k in range(12)]
    kept = [(i, t) for i, t in kept if plain_tiles(t.split(), item, 5) < 0.8 * 12]

    def marked(t):
        out, at = [], 0
        for a, _, b in plain_spans(t):
            if b > at:
                out += [t[at:a], "[REDACTED]"] if a >= at else []
                at = b
        return "".join([*out, t[at:]])

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted((str(i), sp.encode(marked(t))) for i, t in kept)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in corpus_pipeline.run(spark, folder).collect()) == want


def test_last_stage_on_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "one two", "x"), (None, None, "y"), (1, "one two", "x")], "doc_id long, text string, ids string")
    got = sorted((str(r["doc_id"]), r["n_pieces"]) for r in corpus_pipeline.tokens(spark, docs, "").collect())
    assert [n for _, n in got] == [got[0][1], got[0][1], 0] and got[0][1] > 0
    assert corpus_pipeline.tokens(spark, docs.where("false"), "").count() == 0
