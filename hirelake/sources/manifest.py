"""Which folders a table consists of, said by numbered manifests.

``<table>/_manifests/<number>.json`` holds the whole state; the largest number is the table. A change reads it, adds
folders that no one shows yet, and creates the next number, which succeeds for one writer alone; the others look again.
So a run that stops half-way changes nothing, readers see one state, and no writer overwrites another's.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from hirelake.sources import files

_FOLDER = "_manifests"


def new_version() -> str:
    """A folder name that no other writer makes (never read as a number by partition discovery)."""
    return f"v{uuid.uuid4().hex}"


def _numbers(spark: SparkSession, table: str) -> dict[int, float]:
    found = files.children(spark, f"{table}/{_FOLDER}")
    return {int(n.removesuffix(".json")): t for n, t in found.items() if re.fullmatch(r"\d+\.json", n)}


def _read(spark: SparkSession, table: str, number: int) -> dict:
    return json.loads(files.read_text(spark, f"{table}/{_FOLDER}/{number:012d}.json"))


def current(spark: SparkSession, table: str) -> dict:
    """The table's state; empty where there is none."""
    numbers = _numbers(spark, table)
    return _read(spark, table, max(numbers)) if numbers else {}


def change(spark: SparkSession, table: str, new_state: Callable[[dict], dict | None]) -> dict:
    """Replace the state by ``new_state(state)``, called again with a later state where another writer was first.

    ``None`` leaves the table as it is.
    """
    while True:
        number = max(_numbers(spark, table), default=0)
        state = _read(spark, table, number) if number else {}
        new = new_state(state)
        if new is None:
            return state
        if files.create_absent(spark, f"{table}/{_FOLDER}/{number + 1:012d}.json", json.dumps(new)):
            return new


def clear(
    spark: SparkSession, table: str, shown: Callable[[dict], set[str]], keep_seconds: float, named: set[str] = frozenset()
) -> list[str]:
    """Delete generations that nothing shows: returns the folder names deleted.

    ``shown`` gives the folders (``column=value``) of a state. Kept are those of the current state, of every state that was
    current in the last ``keep_seconds`` (readers may still work on it), those in ``named``, and any folder younger
    than that (its writer may not have committed yet).
    """
    limit = time.time() - keep_seconds
    numbers = _numbers(spark, table)
    ordered = sorted(numbers)
    live = [n for n, later in zip(ordered, [*ordered[1:], None], strict=True) if later is None or numbers[later] > limit]
    kept = set(named).union(*[shown(_read(spark, table, n)) for n in live])
    gone = [
        name for name, changed in files.children(spark, table).items()
        if "=" in name and name not in kept and changed <= limit
    ]
    for name in gone:
        files.delete(spark, f"{table}/{name}")
    for n in ordered:
        if n not in live:
            files.delete(spark, f"{table}/{_FOLDER}/{n:012d}.json")
    return gone
