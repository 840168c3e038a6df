import socket
import threading
import time
import urllib.error
import urllib.request

import pytest

from tidemark.pipeline import Pass, TableResult
from tidemark.streaming.loop import Loop
from tidemark.streaming.metrics import Metrics, serve
from tidemark.streaming.wake import address, follow


def test_once_and_errors():
    seen = []
    Loop(lambda: Pass([TableResult("t", 1)]), once=True, on_pass=seen.append).go()
    assert seen[0].rows == 1
    with pytest.raises(ValueError):
        Loop(lambda: Pass(error=ValueError("x")), once=True).go()


def test_pauses_grow_and_stop_ends():
    pauses, loop = [], None

    def fail():
        if len(pauses) > 4:
            loop.end()
        raise OSError("down")

    loop = Loop(fail, first_pause=1, longest_pause=4)
    loop._wait = lambda seconds, wakeable: pauses.append(seconds)
    loop.go()
    assert pauses[:5] == [1, 2, 4, 4, 4]


def test_a_burst_wakes_once():
    passes = []
    loop = Loop(lambda: Pass(), interval=60)

    def on_pass(_):
        passes.append(1)
        if len(passes) == 1:
            for _ in range(5):
                loop.wake.set()
        else:
            loop.end()

    loop.on_pass = on_pass
    loop.go()
    assert len(passes) == 2


def test_metrics_text():
    now = [100.0]
    m = Metrics('a"b', clock=lambda: now[0])
    assert not m.healthy() and 'tidemark_seconds_since_last_pass{instance="a\\"b"} -1' in m.text()
    m.passed(Pass([TableResult("x", 12, 1), TableResult("y", 30)]), 0.5, {"x": 4.5})
    text = m.text()
    for line in ('tidemark_rows_written_total{instance="a\\"b"} 42', 'tidemark_table_rows_written_total{instance="a\\"b",table="x"} 12', 'tidemark_table_rows_quarantined_total{instance="a\\"b",table="x"} 1', 'tidemark_table_lag_seconds{instance="a\\"b",table="x"} 4.500'):
        assert line in text
    assert text.count("# TYPE") == 11 and m.healthy()
    now[0] += 1
    m.failed()
    assert not m.healthy()


def test_reasons():
    now = [1.0]
    m = Metrics("i", clock=lambda: now[0])
    assert m.health() == (False, "no pass has completed yet")
    m.failed(OSError("down"))
    assert m.health() == (False, "last pass failed: down")
    now[0] += 1
    m.passed(Pass())
    assert m.health() == (True, "ok")


def test_server():
    m = Metrics("i")
    server = serve(m)
    url = f"http://127.0.0.1:{server.server_address[1]}"
    try:
        assert urllib.request.urlopen(f"{url}/healthz").status == 200
        with pytest.raises(urllib.error.HTTPError, match="503"):
            urllib.request.urlopen(f"{url}/readyz")
        m.passed(Pass())
        assert urllib.request.urlopen(f"{url}/readyz").status == 200
        assert b"tidemark_up" in urllib.request.urlopen(f"{url}/metrics").read()
    finally:
        server.shutdown()


def test_wake(tmp_path):
    place = str(tmp_path / "s.sock")
    server = socket.socket(socket.AF_UNIX)
    server.bind(place)
    server.listen(1)
    got, stop = threading.Event(), threading.Event()
    follow(f"unix://{place}", got.set, stop, first=0.05)
    for _ in range(2):  # it comes again after the stream has ended
        peer, _ = server.accept()
        assert peer.recv(1000).startswith(b"GET /events")
        peer.sendall(b"HTTP/1.1 200 OK\r\n\r\nevent: x\ndata: {}\n\n")
        assert got.wait(5)
        got.clear()
        peer.close()
        time.sleep(0.01)
    stop.set()
    for bad in ("http://x", "unix://"):
        with pytest.raises(ValueError):
            address(bad)
