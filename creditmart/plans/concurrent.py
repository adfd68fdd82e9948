"""Run independent Spark jobs side by side, so that one's last tasks do not leave cores idle."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")
WIDTH = 4      # jobs submitted at a time


def together(actions: dict[str, Callable[[], T]], width: int = WIDTH) -> dict[str, T]:
    """Results by name, in the given order. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(width) as pool:
        started = {name: pool.submit(action) for name, action in actions.items()}
    return {name: future.result() for name, future in started.items()}
