"""The control plane over HTTP: health, metrics and the denylist."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import unquote, urlsplit

from ..operators.denylist import Denylist
from .metrics import Metrics


def serve(address: str, denylist: Denylist, metrics: Metrics, health: Callable[[], tuple[int, dict]]) -> ThreadingHTTPServer:
    """A server at host:port in a thread of its own; shutdown() ends it.

    GET /healthz, GET /metrics, and /denylist as Denylist.handle answers it; anything else is 404.
    """

    class Handler(BaseHTTPRequestHandler):
        def answer(self) -> None:
            path = unquote(urlsplit(self.path).path)
            kind, body = "application/json", None
            if self.command == "GET" and path == "/healthz":
                status, body = health()
            elif self.command == "GET" and path == "/metrics":
                for entry, on in denylist.gauges.items():
                    metrics.set("denylist_filter_enabled", on, db=entry)
                status, kind, body = 200, "text/plain; version=0.0.4", metrics.text()
            else:
                status, body = denylist.handle(self.command, path)
            data = b"" if body is None or status == 204 else (body if kind.startswith("text") else json.dumps(body)).encode()
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_PUT = do_DELETE = do_POST = answer

        def log_message(self, *args) -> None:
            pass

    host, _, port = address.rpartition(":")
    server = ThreadingHTTPServer((host, int(port)), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
