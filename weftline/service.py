"""Nearest neighbours over HTTP: JSON in, JSON out, from a corpus that is read anew on a timer.

GET /ping; POST /search_by_id {"ids": [...], "k": 10}; POST /search_by_vector
{"vectors": [[...]], "k": 10}; POST /get_goods_id {"n": 5}. Answers hold, for
each id or each vector's place, a list of {neighbour: squared distance}. A
request that can't be answered, such as one for an id that isn't stored, gets
status 500.
"""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import vectors

log = logging.getLogger("weftline.service")


class NeighbourService:
    """Answers requests over ``load()``, a frame of ``id`` and ``v`` (unit vectors; see ``vectors.normalise``)."""

    def __init__(self, load: Callable[[], DataFrame], refresh_seconds: float = 3600):
        self._load, self._seconds = load, refresh_seconds
        self._timer: threading.Timer | None = None
        self._corpus = load().persist()

    def refresh(self) -> None:
        """Reads the corpus anew; requests go on with the old one until the new one is there."""
        fresh = self._load().persist()
        fresh.count()
        self._corpus, old = fresh, self._corpus
        old.unpersist()

    def start_refreshing(self) -> None:
        """Refreshes every ``refresh_seconds``; an attempt that fails is logged and tried again next time."""

        def tick() -> None:
            try:
                self.refresh()
            except Exception:
                log.exception("the corpus stays as it is")
            self.start_refreshing()

        self._timer = threading.Timer(self._seconds, tick)
        self._timer.daemon = True
        self._timer.start()

    def stop(self) -> None:
        """Ends the timer and frees the corpus."""
        if self._timer:
            self._timer.cancel()
        self._corpus.unpersist()

    def _lists(self, found: DataFrame) -> dict:
        out: dict = {}
        for r in found.orderBy("query", "rank_no").collect():
            out.setdefault(str(r["query"]), []).append({str(r.id): r.distance})
        return out

    def search_by_id(self, ids: list, k: int) -> dict:
        """The ``k`` nearest others of each stored id."""
        corpus = self._corpus
        kind = dict(corpus.dtypes)["id"]
        wanted = corpus.sparkSession.createDataFrame([(str(i),) for i in ids], "id string").select(F.col("id").cast(kind).alias("id"))
        missing = wanted.join(corpus, "id", "left_anti").limit(1).collect()
        if missing:
            raise KeyError(missing[0].id)
        return self._lists(vectors.search_by_ids(corpus, wanted, k))

    def search_by_vector(self, given: list, k: int) -> dict:
        """The ``k`` nearest of each vector, by its place in the request."""
        rows = [(n, [float(x) for x in v]) for n, v in enumerate(given)]
        return self._lists(vectors.search_by_vectors(self._corpus, self._corpus.sparkSession.createDataFrame(rows, "id int, v array<double>"), k))

    def get_goods_id(self, n: int) -> list:
        """The first ``n`` ids, in the order in which they are stored if ``load()`` gives a column ``place``."""
        return [r.id for r in vectors.first_ids(self._corpus, "id", n).collect()]

    def answer(self, path: str, body: bytes) -> tuple[int, str]:
        """Status and text of a request."""
        try:
            if path == "/ping":
                return 200, "pong"
            asked = json.loads(body)
            if path == "/search_by_id":
                return 200, json.dumps(self.search_by_id(asked["ids"], int(asked["k"])))
            if path == "/search_by_vector":
                return 200, json.dumps(self.search_by_vector(asked["vectors"], int(asked["k"])))
            if path == "/get_goods_id":
                return 200, json.dumps(self.get_goods_id(int(asked["n"])))
            return 404, "Not found"
        except Exception:
            log.exception("%s", path)
            return 500, "Server error"

    def server(self, host: str = "127.0.0.1", port: int = 5000) -> ThreadingHTTPServer:
        """A server that is ready for ``serve_forever``."""
        service = self

        class Handler(BaseHTTPRequestHandler):
            def _reply(self) -> None:
                status, text = service.answer(self.path, self.rfile.read(int(self.headers.get("Content-Length") or 0)))
                data = text.encode()
                self.send_response(status)
                self.send_header("Content-Type", "application/json" if status == 200 and self.path != "/ping" else "text/plain")
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            do_GET = do_POST = _reply

            def log_message(self, text: str, *args) -> None:
                log.info(text, *args)

        return ThreadingHTTPServer((host, port), Handler)
