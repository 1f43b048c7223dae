"""The change feed source: ranges, repeated batches, a growing feed, a service of pages."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from thicket.streaming import changes, feed

SCHEMA = "position long, k int, v string, at timestamp"


def rows(spark, *found):
    return spark.createDataFrame([(p, k, v) for p, k, v in found], "position long, k int, v string").selectExpr("*", "timestamp_micros(position) AS at")


def test_ranges_of_a_folder(spark, tmp_path):
    folder = f"file://{tmp_path}/feed"
    read = lambda a, b: sorted(r.position for r in feed.between(spark, SCHEMA, a, b, path=folder).collect())
    assert read(-1, 100) == []
    assert feed.append_changes(rows(spark), folder) is None
    assert feed.append_changes(rows(spark, *[(i, i % 3, str(i)) for i in range(0, 40, 2)]), folder) == (0, 38)
    for late in ([(38, 1, "x")], [(20, 1, "x"), (50, 1, "y")], [(None, 1, "z")]):
        with pytest.raises(ValueError):
            feed.append_changes(rows(spark, *late), folder)
    feed.append_changes(rows(spark, (41, 1, "a"), (41, 2, None), (99, 1, "b")), folder)
    (tmp_path / "feed/segment=00000000000000000100-00000000000000000200").mkdir()  # its writing has not ended
    assert read(-1, 1000) == [*range(0, 40, 2), 41, 41, 99]
    assert read(10, 41) == [*range(12, 40, 2), 41, 41]
    assert read(41, 98) == [] and read(41, 99) == [99]
    one = feed.between(spark, SCHEMA, 98, 99, path=folder).first()
    assert (one.k, one.v, one.at.microsecond) == (1, "b", 99)


def test_stream_of_a_growing_feed(spark, tmp_path):
    folder, target, state = (f"file://{tmp_path}/{n}" for n in ("feed", "table", "state"))

    def run():
        changes.upsert_stream(feed.stream(spark, SCHEMA, path=folder), target, "k", ("position",), state, 4).awaitTermination()
        return {r.k: r.v for r in changes.snapshot(spark, target, SCHEMA, changes.last_epoch(spark, target)).collect()}

    assert changes.last_epoch(spark, target) == -1
    feed.append_changes(rows(spark, *[(i, i % 5, f"a{i}") for i in range(20)]), folder)
    first = {k: f"a{15 + k}" for k in range(5)}
    assert run() == first and run() == first  # nothing new, no epoch
    assert changes.last_epoch(spark, target) == 0
    feed.append_changes(rows(spark, (30, 2, "b"), (31, 7, "c"), (32, 2, None)), folder)
    second = first | {2: None, 7: "c"}
    assert run() == second and changes.last_epoch(spark, target) == 1
    files = sorted(p.parent.name for p in (tmp_path / "table/data/epoch=1").glob("bucket=*/*.parquet"))
    changes.forget_last_commit(spark, state)
    assert run() == second and changes.last_epoch(spark, target) == 1  # the same batch once more
    assert sorted(p.parent.name for p in (tmp_path / "table/data/epoch=1").glob("bucket=*/*.parquet")) == files


def test_service_of_pages(spark):
    found = [{"fecha": 1000 + i // 2, "nregistro": str(i), "cambio": ["ft"] if i % 3 else None} for i in range(25)]
    asked, busy = [], [2]

    class Service(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: int(v[0]) for k, v in parse_qs(urlparse(self.path).query).items()}
            asked.append(q)
            if q["pagina"] == 2 and busy[0]:
                busy[0] -= 1
                return self.send_error(503)
            new = [r for r in found if r["fecha"] > q["fecha"]]
            body = json.dumps({"totalFilas": len(new), "resultados": new[(q["pagina"] - 1) * q["pagesize"] :][: q["pagesize"]]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            return

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        options = {"client": "thicket.streaming.feed:ServiceFeed", "url": f"http://127.0.0.1:{server.server_port}/changes", "pagesize": "4"}
        schema = "position long, nregistro string, cambio array<string>"
        got = feed.between(spark, schema, 1001, 1010, **options).collect()
        assert sorted((r.position, r.nregistro, r.cambio) for r in got) == sorted((r["fecha"], r["nregistro"], r["cambio"] or []) for r in found if 1001 < r["fecha"] <= 1010)
        assert {q["fecha"] for q in asked} == {1001} and busy == [0]
        ids = changes.changed_ids(feed.between(spark, schema, -1, 5000, **options))
        assert {r.nregistro for r in ids.collect()} == {str(i) for i in range(25) if i % 3}
    finally:
        server.shutdown()
