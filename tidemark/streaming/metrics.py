"""What the loop has done, as Prometheus text, and a small server for it."""

from __future__ import annotations

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from ..pipeline import Pass


def _label(value: str) -> str:
    return value.replace("\\", "\\\\").replace("\n", "\\n").replace('"', '\\"')


class Metrics:
    def __init__(self, instance: str, clock=time.time):
        self.instance, self.clock, self.began = instance, clock, clock()
        self._lock = threading.Lock()
        self.passes = self.errors = self.rows = self.quarantined = 0
        self.last_pass = self.last_error = None
        self.error = ""
        self.last_seconds = 0.0
        self.table_rows: dict[str, int] = {}
        self.table_quarantined: dict[str, int] = {}
        self.lags: dict[str, float] = {}

    def passed(self, done: Pass, seconds: float = 0.0, lags: dict[str, float] | None = None) -> None:
        with self._lock:
            self.passes += 1
            self.rows += done.rows
            self.quarantined += done.quarantined
            self.last_pass, self.last_seconds, self.lags = self.clock(), seconds, dict(lags or {})
            for t in done.tables:
                self.table_rows[t.table] = self.table_rows.get(t.table, 0) + t.rows
                self.table_quarantined[t.table] = self.table_quarantined.get(t.table, 0) + t.quarantined

    def failed(self, error: object = "") -> None:
        with self._lock:
            self.errors += 1
            self.last_error, self.error = self.clock(), str(error)

    def health(self) -> tuple[bool, str]:
        """Whether a pass has completed and no error is newer; and if not, why."""
        with self._lock:
            if self.last_pass is None and self.last_error is None:
                return False, "no pass has completed yet"
            if self.last_error is not None and (self.last_pass is None or self.last_error > self.last_pass):
                return False, f"last pass failed: {self.error}"
            return True, "ok"

    def healthy(self) -> bool:
        return self.health()[0]

    def text(self) -> str:
        up = int(self.healthy())
        with self._lock:
            now, own = self.clock(), f'instance="{_label(self.instance)}"'
            single = [
                ("up", "gauge", up), ("uptime_seconds", "gauge", round(now - self.began, 3)), ("passes_total", "counter", self.passes),
                ("pass_errors_total", "counter", self.errors), ("rows_written_total", "counter", self.rows), ("rows_quarantined_total", "counter", self.quarantined),
                ("last_pass_duration_seconds", "gauge", round(self.last_seconds, 3)), ("seconds_since_last_pass", "gauge", -1 if self.last_pass is None else round(now - self.last_pass, 3)),
            ]
            tables = [("table_rows_written_total", "counter", self.table_rows), ("table_rows_quarantined_total", "counter", self.table_quarantined), ("table_lag_seconds", "gauge", {t: f"{v:.3f}" for t, v in self.lags.items()})]
            lines = []
            for name, kind, value in single:
                lines += [f"# TYPE tidemark_{name} {kind}", f"tidemark_{name}{{{own}}} {value}"]
            for name, kind, values in tables:
                lines.append(f"# TYPE tidemark_{name} {kind}")
                lines += [f'tidemark_{name}{{{own},table="{_label(t)}"}} {values[t]}' for t in sorted(values)]
        return "\n".join(lines) + "\n"


def serve(metrics: Metrics, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """/metrics, /healthz (the process lives) and /readyz (503 until a pass is done and the last one succeeded)."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            ready, why = metrics.health()
            code, body = {"/metrics": (200, metrics.text()), "/healthz": (200, "ok\n"), "/readyz": (200, "ready\n") if ready else (503, f"not ready: {why}\n")}.get(self.path, (404, "not found\n"))
            self.send_response(code)
            self.send_header("Content-Type", "text/plain; version=0.0.4")
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
