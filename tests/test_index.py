import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
import json
import math
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.functions.expressions import vector_problem
from docmill.functions.identity import POINT_PREFIX, fingerprint, point_id, table_fingerprint
from docmill.operators import vindex
from docmill.operators.artifacts import chunk_violations, load_chunks, read_json, read_jsonl, write_chunks, write_jsonl
from docmill.operators.chunking import chunk_configuration, chunk_structured, token_measure
from docmill.operators.embedding import EmbeddingProvider, HashingEmbedding, ModelServerEmbedding, check_texts, check_vectors, embed_table, query_prompt
from docmill.operators.retrieval import batch_top_k, compare_collections, cosine_top_k, recall_at_k, retrieve
from docmill.schemas import CHUNK
from docmill.streaming.ingest import index_stream, stream_chunks
from tests.fixtures import section, to_table


def artifact(spark, folder, size=400):
    rows = [section("a.md", i, f"The {w} is refined by the {w} solver. " * 6, ["Guide", w]) for i, w in enumerate(["mesh", "matrix", "boundary", "kernel"])]
    chunks = chunk_structured(to_table(spark, rows), size, 100)
    write_chunks(chunks, folder, "corpus", chunk_configuration("structured", size, 0, 100))
    return load_chunks(spark, folder)


def test_identities(spark):
    names = ["a", "", "é漢🧮", "x" * 500]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", point_id(F.col("n")).alias("p"))
    assert {r.n: r.p for r in df.collect()} == {n: str(uuid.uuid5(uuid.NAMESPACE_URL, POINT_PREFIX + n)) for n in names}
    assert fingerprint({"b": 1, "a": "é"}) == fingerprint({"a": "é", "b": 1})
    one = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    assert table_fingerprint(one) == table_fingerprint(one.repartition(3)) != table_fingerprint(one.distinct())


def test_vectors_and_texts():
    assert check_vectors([[1.0, 0]], 1, 2).tolist() == [[1.0, 0.0]] and check_vectors([], 0, 2).shape[0] == 0
    for bad in ([[1.0]], [[1.0, 2.0], [3.0]], [["1", 2.0]], [[math.nan, 1]], [[0.0, 0.0]], [[True, 1.0]], [[None, 1.0]], []):
        with pytest.raises(ValueError):
            check_vectors(bad, 1, 2)
    for bad in ([], [" "], [None]):
        with pytest.raises(ValueError):
            check_texts(bad)
    assert query_prompt("q", "i") == "Instruct: i\nQuery: q"
    with pytest.raises(ValueError):
        query_prompt(" ")
    assert isinstance(HashingEmbedding(), EmbeddingProvider)


def test_native_vector_check(spark):
    rows = [([1.0, 0.0],), ([0.0, 0.0],), ([float("nan"), 1.0],), ([float("inf"), 1.0],), ([1.0],), (None,), ([None, 1.0],)]
    got = [r.problem for r in spark.createDataFrame(rows, "vector array<float>").select(vector_problem(F.col("vector"), 2).alias("problem")).collect()]
    assert got == [None, "zero", "non-finite", "non-finite", "dimension", "null", "non-finite"]


def test_index_resume_and_retrieve(spark, tmp_path):
    chunks, manifest = artifact(spark, f"{tmp_path}/chunks")
    provider, folder = HashingEmbedding(64), f"{tmp_path}/collection"
    with pytest.raises(ValueError, match="no supported state"):
        retrieve(spark, "mesh", folder, provider)
    half = vindex.missing_chunks(vindex.collection_points(spark, folder), chunks).orderBy("id").limit(2)
    embed_table(half.select("point_id", "text", F.struct("id", "text", "body", "metadata").alias("payload")), provider).select("point_id", "vector", "payload").write.parquet(f"{folder}/points")
    state = vindex.index_chunks(chunks, manifest, folder, provider, 3, part_rows=3)
    assert state["status"] == "complete" and state["indexed_chunks"] == manifest["chunks"]
    journal = [read_json(spark, f"{folder}/journal/{n}") for n in vindex.Journal(spark, folder).names()]
    parts = -(-manifest["chunks"] // 3)
    assert [e.get("part") for e in journal] == [None, *(f"{k + 1}/{parts}" for k in range(parts)), None]
    assert [e["indexed_chunks"] for e in journal] == sorted(e["indexed_chunks"] for e in journal) and journal[0]["indexed_chunks"] == 2
    assert vindex.index_chunks(chunks, manifest, folder, provider)["status"] == "complete"
    assert vindex.collection_points(spark, folder).count() == manifest["chunks"]
    best = retrieve(spark, "how is the boundary refined", folder, provider, 2).collect()
    assert "boundary" in best[0].chunk.text and best[0].score >= best[1].score and best[0].citations[0].section_id.endswith(":2")
    assert compare_collections(spark, "kernel", [folder, folder], provider, 1).count() == 2
    with pytest.raises(ValueError, match="positive"):
        retrieve(spark, "x", folder, provider, 0)
    with pytest.raises(ValueError, match="differs"):
        retrieve(spark, "x", folder, HashingEmbedding(32))
    with pytest.raises(ValueError, match="another artifact"):
        vindex.index_chunks(chunks, manifest, folder, HashingEmbedding(32))
    with pytest.raises(ValueError, match="positive"):
        vindex.index_chunks(chunks, manifest, folder, provider, 0)
    vindex.collection_points(spark, folder).limit(1).withColumn("point_id", F.lit("more")).write.mode("append").parquet(f"{folder}/points")
    with pytest.raises(ValueError, match="changed"):
        retrieve(spark, "x", folder, provider)
    with pytest.raises(ValueError, match="does not match"):
        vindex.index_chunks(chunks, manifest, folder, provider)
    assert vindex.collection_state(spark, folder)["status"] == "incomplete"
    with pytest.raises(ValueError, match="incomplete"):
        retrieve(spark, "x", folder, provider)
    for change, problem in (({"identity": "0"}, "identity"), ({"vectors": {"size": 64, "distance": "dot"}}, "vectors"), ({"schema_version": 0}, "no supported")):
        good = vindex.collection_state(spark, folder)
        vindex.Journal(spark, folder).add(good, **change)
        with pytest.raises(ValueError, match=problem):
            vindex.collection_state(spark, folder)
        vindex.Journal(spark, folder).add(good)
    assert not vindex.completeness(vindex.collection_points(spark, folder), chunks).first().complete


def test_payload_must_match(spark, tmp_path):
    chunks, manifest = artifact(spark, f"{tmp_path}/chunks")
    provider, folder = HashingEmbedding(64), f"{tmp_path}/c"
    other = chunks.withColumn("body", F.lit("changed")).withColumn("point_id", point_id(F.col("id")))
    embed_table(other.select("point_id", "text", F.struct("id", "text", "body", "metadata").alias("payload")), provider).select("point_id", "vector", "payload").write.parquet(f"{folder}/points")
    with pytest.raises(ValueError, match="another payload"):
        vindex.index_chunks(chunks, manifest, folder, provider)
    assert "payload" in vindex.collection_state(spark, folder)["error"]


def test_chunk_artifact_checks(spark, tmp_path):
    chunks, manifest = artifact(spark, f"{tmp_path}/chunks")
    assert manifest["chunks"] == chunks.count() and chunk_violations(chunks).count() == 0
    bad = chunks.unionByName(chunks.limit(1)).unionByName(chunks.limit(1).withColumn("id", F.lit(""))).unionByName(chunks.limit(1).withColumns({"id": F.lit("n"), "text": F.lit(" ")}))
    assert {r.problem: r.rows for r in chunk_violations(bad).collect()} == {"duplicate": 2, "id": 1, "text": 1}
    chunks.limit(1).write.mode("append").parquet(f"{tmp_path}/chunks/chunks")
    with pytest.raises(ValueError, match="do not match"):
        load_chunks(spark, f"{tmp_path}/chunks")
    odd = chunks.withColumn("text", F.concat("text", F.lit(" \u0085\r end")))
    write_jsonl(odd, f"{tmp_path}/jsonl")
    assert table_fingerprint(read_jsonl(spark, f"{tmp_path}/jsonl", CHUNK)) == table_fingerprint(odd)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    points = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(900, None), (901, [0.0] * 8)], "vec_id int, vector array<float>")
    q = [float(v) for v in x[3]]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = np.argsort(-(unit @ unit[3]), kind="stable")[:5].tolist()
    assert [r.vec_id for r in cosine_top_k(points, q, 5, "vec_id").collect()] == want
    queries = points.filter("vec_id % 10 = 3").select(F.col("vec_id").alias("query_id"), "vector")
    got = {}
    for r in batch_top_k(points, queries, 5, 8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    assert got[3] == want and len(got) == 20
    relevant = spark.createDataFrame([(3, 3), (3, -1), (13, -1)], "query_id bigint, id bigint")
    report = {r.query_id: (r.recall, r.reciprocal_rank) for r in recall_at_k(batch_top_k(points, queries, 5, 8), relevant, 5).collect()}
    assert report == {3: (0.5, 1.0), 13: (0.0, 0.0)}
    assert batch_top_k(points, queries.limit(0), 5, 8).count() == 0 and batch_top_k(points.limit(0), queries, 5, 8).count() == 0
    ties = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(9)], "vec_id int, vector array<float>")
    asked = ties.filter("vec_id = 4").selectExpr("vec_id AS query_id", "vector", "1 AS score")
    assert [r.id for r in batch_top_k(ties, asked, 3, 2).orderBy("rank").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        cosine_top_k(points, [0.0] * 8, 5)


def test_stream_adds_missing_points_once(spark, tmp_path):
    chunks, _ = artifact(spark, f"{tmp_path}/chunks")
    chunks.unionByName(chunks.limit(2)).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        index_stream(stream_chunks(spark, f"{tmp_path}/in"), f"{tmp_path}/c", HashingEmbedding(16), f"{tmp_path}/check").awaitTermination()
    assert vindex.collection_points(spark, f"{tmp_path}/c").count() == chunks.count()


def test_model_server(spark):
    class Server(BaseHTTPRequestHandler):
        digest = "d1"

        def reply(self, value):
            body = json.dumps(value).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.reply({"models": [{"model": "m", "digest": Server.digest}]})

        def do_POST(self):
            texts = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["input"]
            self.reply({"model": "m", "embeddings": [[float(len(t)), 1.0] for t in texts]})

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    provider = ModelServerEmbedding(url, "m", 2)
    assert provider.embed_documents(["ab"]) == [[2.0, 1.0]] and provider.configuration()["digest"] == "d1"
    table = embed_table(spark.createDataFrame([("abc",)], "text string"), provider)
    assert table.first().vector == [3.0, 1.0]
    with pytest.raises(ValueError, match="no model"):
        ModelServerEmbedding(url, "other")
    Server.digest = "d2"
    with pytest.raises(ValueError, match="changed"):
        provider.embed_query("q")
    server.shutdown()
    server.server_close()
    with pytest.raises(ValueError, match="reached"):
        ModelServerEmbedding(url, "m")


def test_token_budget(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel({"[U]": 0}, unk_token="[U]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    measure = token_measure(tokenizer.to_str())
    chunks = chunk_structured(to_table(spark, [section("a", 0, "one two three. " * 40)]), 30, 10, measure, "tokens:x").collect()
    assert len(chunks) > 3 and all(measure(c.text) <= 30 for c in chunks)
