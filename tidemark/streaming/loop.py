"""Pass after pass: at intervals or when woken, with growing pauses after errors."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from ..pipeline import Pass


@dataclass
class Loop:
    """run: one pass; on_error says whether to go on; stop ends the loop cleanly, also while it waits."""

    run: Callable[[], Pass]
    interval: float = 10.0
    first_pause: float = 1.0
    longest_pause: float = 120.0
    once: bool = False
    on_pass: Callable[[Pass], None] = lambda _: None
    on_error: Callable[[Exception], bool] = lambda _: True

    def __post_init__(self):
        self.stop, self.wake = threading.Event(), threading.Event()

    def _wait(self, seconds: float, wakeable: bool) -> None:
        if not wakeable:
            self.stop.wait(seconds)
            return
        # a burst of signals is one; stopping wakes too
        self.wake.wait(seconds)
        self.wake.clear()

    def end(self) -> None:
        self.stop.set()
        self.wake.set()

    def go(self) -> None:
        pause = self.first_pause
        while not self.stop.is_set():
            try:
                done = self.run()
                error = done.error
            except Exception as e:  # noqa: BLE001
                done, error = Pass(error=e), e
            if error is not None:
                if not self.on_error(error) or self.once:
                    raise error
                self._wait(pause, False)
                pause = min(2 * pause, self.longest_pause)
                continue
            pause = self.first_pause
            self.on_pass(done)
            if self.once:
                return
            self._wait(self.interval, True)
