"""What each step was made from: source hashes, tables used and made, stale steps, and timings."""

from __future__ import annotations

import ast
import hashlib
import json
import os
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from pathlib import Path


def _bare(tree: ast.AST) -> ast.AST:
    """The tree without docstrings."""
    for node in ast.walk(tree):
        body = getattr(node, "body", None)
        if isinstance(body, list) and body and isinstance(body[0], ast.Expr) and isinstance(body[0].value, ast.Constant) and isinstance(body[0].value.value, str):
            node.body = body[1:] or [ast.Pass()]
    return tree


def source_hash(source: str) -> str:
    """A hash of what a program does: comments, docstrings, blank lines and layout don't change it."""
    return hashlib.sha256(ast.dump(_bare(ast.parse(source))).encode()).hexdigest()[:16]


def table_version(path: str | Path) -> str:
    """A fingerprint of a table's files by name, size and time of change; 'missing' without any."""
    path = Path(path)
    files = sorted(p for p in path.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))) if path.is_dir() else [path] if path.is_file() else []
    if not files:
        return "missing"
    text = "\n".join(f"{p.relative_to(path) if p != path else p.name}:{p.stat().st_size}:{p.stat().st_mtime_ns}" for p in files)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


@dataclass
class Record:
    source: str
    used: dict[str, str]
    made: dict[str, str]
    seconds: float


@dataclass
class Ledger:
    """Records of the steps, kept as one JSON file that is replaced as a whole."""

    path: Path
    records: dict[str, Record] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> Ledger:
        path = Path(path)
        found = json.loads(path.read_text()) if path.exists() else {}
        return cls(path, {k: Record(**v) for k, v in found.items()})

    def save(self) -> None:
        part = self.path.with_suffix(".part")
        part.write_text(json.dumps({k: asdict(v) for k, v in sorted(self.records.items())}, indent=1))
        os.replace(part, self.path)

    @contextmanager
    def step(self, name: str, source: str, used: list[str], made: list[str]) -> Iterator[None]:
        """Run a step and record it; one that fails leaves its old record alone."""
        inputs, began = {p: table_version(p) for p in used}, time.perf_counter()
        yield
        self.records[name] = Record(source_hash(source), inputs, {p: table_version(p) for p in made}, time.perf_counter() - began)
        self.save()

    def stale(self, name: str, source: str) -> list[str]:
        """Why a step's results are out of date, nothing if they aren't."""
        r = self.records.get(name)
        if r is None:
            return ["never run"]
        why = ["source changed"] if r.source != source_hash(source) else []
        why += [f"input changed: {p}" for p, v in sorted(r.used.items()) if table_version(p) != v]
        return why + [f"output {'missing' if now == 'missing' else 'changed'}: {p}" for p, v in sorted(r.made.items()) if (now := table_version(p)) != v]

    def all_stale(self, sources: dict[str, str]) -> dict[str, list[str]]:
        """The stale steps with their reasons; a step that reads what a stale one makes is stale too."""
        why = {k: found for k, text in sources.items() if (found := self.stale(k, text))}
        while True:
            dirty = {p: k for k in why if k in self.records for p in self.records[k].made}
            more = {k: sorted({f"made by a stale step: {p}" for p in r.used if p in dirty}) for k, r in self.records.items() if k in sources and k not in why}
            more = {k: v for k, v in more.items() if v}
            if not more:
                return why
            why |= more


class Tracked:
    """A mapping's or object's fields, and which of them have been read, as dotted names."""

    def __init__(self, value: object, used: set[str] | None = None, name: str = "") -> None:
        self._value, self._name = value, name
        self.used = set() if used is None else used

    def _field(self, key: str, value: object) -> object:
        name = f"{self._name}.{key}" if self._name else key
        self.used.add(name)
        return Tracked(value, self.used, name) if isinstance(value, dict) or hasattr(value, "__dataclass_fields__") else value

    def __getattr__(self, key: str) -> object:
        if key.startswith("_"):
            raise AttributeError(key)
        return self._field(key, self._value[key] if isinstance(self._value, dict) else getattr(self._value, key))

    def __getitem__(self, key: str) -> object:
        return self._field(key, self._value[key])

    def unused(self) -> set[str]:
        """Top-level fields that nothing has read."""
        names = self._value if isinstance(self._value, dict) else self._value.__dataclass_fields__
        return {k for k in names if k not in self.used}


class Steps:
    """Numbered, nested steps (1, 1.1, 1.2, 2) and how long each took."""

    def __init__(self, tell=print) -> None:
        self.took: list[tuple[str, str, float]] = []
        self._counts, self._tell = [0], tell

    @contextmanager
    def step(self, title: str) -> Iterator[str]:
        self._counts[-1] += 1
        number = ".".join(map(str, self._counts))
        self._tell(f"{number} {title}")
        self._counts.append(0)
        began = time.perf_counter()
        try:
            yield number
        finally:
            self._counts.pop()
            self.took.append((number, title, time.perf_counter() - began))
