"""Running steps in order with run ids, invariants, timings, resume and reports."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class InvariantError(RuntimeError):
    pass


def expect(ok: bool, message: str) -> None:
    if not ok:
        raise InvariantError(message)


def expect_unique(df: DataFrame, keys: list[str]) -> None:
    row = df.agg(F.count("*").alias("n"), F.countDistinct(F.struct(*keys)).alias("d")).first()
    expect(row.n == row.d, f"{row.n - row.d} rows repeat {', '.join(keys)}")


def expect_equal_rows(a: DataFrame, b: DataFrame) -> None:
    n, m = a.count(), b.count()
    expect(n == m, f"{n} rows became {m}")


def expect_rows(df: DataFrame, what: str = "rows") -> None:
    expect(not df.isEmpty(), f"no {what} selected")


def expect_no_orphans(orphans: DataFrame, what: str) -> None:
    n = orphans.count()
    expect(n == 0, f"{n} {what} point to nothing")


def expect_dimension(df: DataFrame, col: str, size: int) -> None:
    n = df.where(F.size(col) != size).count()
    expect(n == 0, f"{n} vectors do not have {size} components")


def parse_limit(value: str | int | None, default: int | None, full: bool = False) -> int | None:
    """None is unlimited; full lifts every limit."""
    if full:
        return None
    if value is None:
        return default
    return None if str(value).lower() in ("all", "none", "0") else int(value)


@dataclass
class Step:
    """name, and a function of (state: names to run ids and values) that gives values to add."""

    name: str
    run: Callable[[dict], dict]


@dataclass
class Runner:
    steps: list[Step]
    state: dict = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    def selected(self, start: str | None = None, end: str | None = None) -> list[Step]:
        names = [s.name for s in self.steps]
        for name in (start, end):
            expect(name is None or name in names, f"no step {name}")
        a, b = names.index(start) if start else 0, names.index(end) if end else len(names) - 1
        expect(a <= b, f"{start} comes after {end}")
        return self.steps[a : b + 1]

    @contextmanager
    def timed(self, name: str):
        began = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = round(time.monotonic() - began, 3)

    def go(self, start: str | None = None, end: str | None = None, dry_run: bool = False, state_path: str | None = None) -> dict:
        """Runs the steps; state_path keeps the state after each, and gives it on a later call."""
        path = Path(state_path) if state_path else None
        if path and path.exists():
            self.state = json.loads(path.read_text()) | self.state
        for step in self.selected(start, end):
            if dry_run:
                continue
            with self.timed(step.name):
                self.state |= step.run(dict(self.state)) or {}
            if path:
                path.write_text(json.dumps(self.state, sort_keys=True, default=str))
        return self.state


def validate_prompts(prompts: dict, stages: list[str], placeholders: dict[str, list[str]]) -> None:
    """A prompt registry: a version, each stage in order, each template with its placeholders."""
    expect(bool(prompts.get("version")), "the prompts have no version")
    found = [s for s in prompts if s != "version"]
    expect(found == stages, f"stages are {found}, not {stages}")
    for stage in stages:
        for name in placeholders.get(stage, []):
            expect("{{" + name + "}}" in prompts[stage].get("template", ""), f"{stage} lacks {name}")


def load_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
