"""Fetching from a server that this module starts."""

import http.server
import threading
import time

import pytest

from corpusloom.sources import fetching


class Pages(http.server.BaseHTTPRequestHandler):
    asked: list = []

    def do_GET(self):
        Pages.asked.append(self.path)
        self.protocol_version = "HTTP/1.0"
        if self.path == "/moved":
            self.send_response(302)
            self.send_header("Location", "/page")
            return self.end_headers()
        if self.path == "/away":
            self.send_response(301)
            self.send_header("Location", "http://localhost.invalid/page")
            return self.end_headers()
        if self.path == "/loop":
            self.send_response(302)
            self.send_header("Location", "/loop")
            return self.end_headers()
        if self.path == "/missing":
            return self.send_error(404)
        if self.path == "/silent":
            time.sleep(3)
        if self.path == "/page" and self.headers.get("If-None-Match") == '"v1"':
            self.send_response(304)
            return self.end_headers()
        body = b"x" * 5000 if self.path in ("/big", "/endless") else b"<p>page</p>"
        self.send_response(200)
        self.send_header("Content-Type", "text/html; charset=utf-8")
        if self.path == "/big":
            self.send_header("Content-Length", str(len(body)))
        self.send_header("ETag", '"v1"')
        self.send_header("Last-Modified", "Mon, 01 Jan 2024 00:00:00 GMT")
        self.end_headers()
        try:
            self.wfile.write(body)
        except OSError:
            pass

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_a_fetch(server):
    got = fetching.fetch(f"{server}/moved", {"127.0.0.1"})
    assert (got["status"], got["content"], got["etag"], got["mime_type"], got["final_url"]) == ("collected", b"<p>page</p>", '"v1"', "text/html", f"{server}/page")
    assert fetching.fetch(f"{server}/page", etag='"v1"')["status"] == "unchanged"
    for path, more, reason in (("missing", {}, "HTTP 404"), ("away", {"hosts": {"127.0.0.1"}}, "host localhost.invalid"), ("loop", {}, "too many redirects"), ("big", {"cap": 4999}, "more than 4999"), ("endless", {"cap": 4999}, "more than 4999"), ("silent", {"timeout": 0.3}, "timed out")):
        got = fetching.fetch(f"{server}/{path}", **more)
        assert got["status"] == "failed" and reason in got["reason"] and got["content"] is None, (path, got)
    assert fetching.fetch(f"{server}/endless", cap=5000)["bytes"] == 5000
    for url in ("file:///etc/hosts", "", "nonsense", "http://127.0.0.1:9/closed"):
        assert fetching.fetch(url, timeout=2)["status"] == "failed"


def test_a_collection(spark, server):
    host = "127.0.0.1"
    declared = spark.createDataFrame(
        [("a", "t", f"{server}/page", "text/html"), ("b", "t", f"{server}/other", "text/html"), ("c", "t", f"{server}/missing", "text/html"), ("d", "t", "http://elsewhere.invalid/x", "text/html"), ("e", "The Forbidden", f"{server}/page", "text/html"), ("f", "t", None, "text/html")],
        "source_id string, title string, url string, mime_type string",
    )
    none = spark.createDataFrame([], "source_id string, url string, status string, reason string, sha256 string, bytes long, mime_type string, etag string, last_modified string, final_url string, retrieved_at string")
    no_objects = spark.createDataFrame([], "source_id string, url string, sha256 string")
    every, new, manifest = fetching.collect(declared, [host], ["forbidden"], none, no_objects, False, "2024-01-01")
    rows = {r.source_id: r for r in every.collect()}
    assert {k: r.status for k, r in rows.items()} == {"a": "collected", "b": "collected", "c": "failed", "d": "failed", "e": "failed", "f": "failed"}
    assert rows["c"].reason == "HTTP 404" and rows["d"].reason == "host" and rows["e"].reason == "word forbidden"
    objects = new.collect()
    assert len(objects) == 1 and objects[0].relative_path == f"raw/{rows['a'].sha256}.html"  # one content, one object
    assert sorted(r.source_id for r in manifest.collect()) == ["a", "b"]
    registry = spark.createDataFrame([r for r in rows.values()], none.schema)
    held = registry.where("status = 'collected'").select("source_id", "url", "sha256")
    Pages.asked.clear()
    again, new, manifest = fetching.collect(declared, [host], ["forbidden"], registry, held, False, "2024-01-02")
    assert {r.source_id: (r.status, r.retrieved_at) for r in again.collect()}["a"] == ("collected", "2024-01-01")
    assert set(Pages.asked) == {"/missing"} and new.count() == 0 and manifest.count() == 0
    fresh, new, _ = fetching.collect(declared, [host], ["forbidden"], registry, held, True, "2024-01-03")
    found = {r.source_id: r for r in fresh.collect()}
    assert found["a"].status == "collected" and found["a"].sha256 == rows["a"].sha256 and found["a"].retrieved_at == "2024-01-03" and new.count() == 0


def test_an_opener_serves_many_urls(monkeypatch):
    """Building one reads the trusted certificates, which takes longer than a page."""
    import urllib.request

    opener = urllib.request.build_opener(fetching._NoRedirect)
    monkeypatch.setattr(urllib.request, "build_opener", lambda *handlers: pytest.fail("built again"))
    assert [fetching.fetch(f"data:,{n}", opener=opener)["content"] for n in range(3)] == [b"0", b"1", b"2"]
