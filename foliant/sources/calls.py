"""Calls to slow services from within a task: several at a time, each with a deadline, all with one budget."""
from __future__ import annotations

import queue
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from typing import Any

DEADLINE, BUDGET = "error: deadline", "error: budget"


def called(items: Iterable, call: Callable[[Any], Any], width: int = 1, deadline: float | None = None, budget: float | None = None, ordered: bool = False) -> Iterator[tuple[Any, Any, str]]:
    """(item, result, status) of call(item), at most `width` at a time, as they finish, or in the items' order.

    status: "success", "not_found" for a result of None, "error: ..." for an exception, DEADLINE for a call that takes
    longer than `deadline` seconds, BUDGET for what isn't done after `budget` seconds in all. A call that hangs gives up
    its place at its deadline; its thread can't be ended, and goes with the process. One call at a time without deadline
    or budget runs in the caller's thread. Items are drawn as places get free, and results are given in the caller's
    thread."""
    if width <= 1 and deadline is None and budget is None:
        for item in items:
            yield (item, *_made(call, item))
        return
    done: queue.SimpleQueue = queue.SimpleQueue()
    end = None if budget is None else time.monotonic() + budget
    source, running, held, number, given = iter(items), {}, {}, 0, 0
    exhausted = False

    def work(k: int, item: Any) -> None:
        done.put((k, _made(call, item)))

    while True:
        now = time.monotonic()
        late = end is not None and now >= end
        while not exhausted and len(running) < width:
            item = next(source, done)  # `done` can't be an item
            if item is done:
                exhausted = True
            elif late:
                held[number] = (item, None, BUDGET)
                number += 1
                break
            else:
                running[number] = (item, None if deadline is None else now + deadline)
                threading.Thread(target=work, args=(number, item), daemon=True).start()
                number += 1
        for k in [k for k, (_, at) in running.items() if late or (at is not None and now >= at)]:
            held[k] = (running.pop(k)[0], None, BUDGET if late else DEADLINE)
        if ordered:
            while given in held:
                yield held.pop(given)
                given += 1
        else:
            yield from [held.pop(k) for k in list(held)]
        if exhausted and not running:
            if not held:
                return
            continue
        if not running:
            continue
        times = [at for _, at in running.values() if at is not None] + ([end] if end is not None else [])
        try:
            k, found = done.get(timeout=max(0.0, min(times) - time.monotonic()) if times else None)
        except queue.Empty:
            continue
        if k in running:  # else its deadline has passed
            held[k] = (running.pop(k)[0], *found)


def _made(call: Callable[[Any], Any], item: Any) -> tuple[Any, str]:
    try:
        found = call(item)
    except Exception as e:  # noqa: BLE001  one call's failure is its row's
        return None, f"error: {e}"
    return (None, "not_found") if found is None else (found, "success")
