"""Server-sent events on a Unix socket, as nudges: their contents don't matter."""

from __future__ import annotations

import socket
import threading
from collections.abc import Callable


def address(url: str) -> tuple[str, str]:
    """(socket path, request path) of unix:///run/x.sock or unix:///run/x.sock:/events."""
    if not url.startswith("unix://") or len(url) == len("unix://"):
        raise ValueError(f"not a unix:// address: {url!r}")
    place, _, path = url[len("unix://") :].partition(":")
    return place, path or "/events"


def listen(url: str, nudge: Callable[[], None], stop: threading.Event) -> None:
    """Reads one connection until it ends, nudging for each event's data."""
    place, path = address(url)
    with socket.socket(socket.AF_UNIX) as s:
        s.settimeout(0.5)
        s.connect(place)
        s.sendall(f"GET {path} HTTP/1.1\r\nHost: localhost\r\nAccept: text/event-stream\r\n\r\n".encode())
        held = b""
        while not stop.is_set():
            try:
                got = s.recv(65536)
            except TimeoutError:
                continue
            if not got:
                raise ConnectionError("the event stream has ended")
            *lines, held = (held + got).split(b"\n")
            if any(x.startswith(b"data:") for x in lines):
                nudge()


def follow(url: str, nudge: Callable[[], None], stop: threading.Event, first: float = 1.0, longest: float = 60.0) -> threading.Thread:
    """A thread that connects again and again, with growing pauses. A malformed address is an error at once."""
    address(url)

    def run():
        pause = first

        def heard():
            nonlocal pause
            pause = first  # the connection works
            nudge()

        while not stop.is_set():
            try:
                listen(url, heard, stop)
            except OSError:
                stop.wait(pause)
                pause = min(2 * pause, longest)

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    return thread
