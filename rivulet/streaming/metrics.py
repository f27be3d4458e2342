"""Counters, gauges and histograms of a running service, and their text exposition."""

from __future__ import annotations

import threading
from collections.abc import Iterable


class Metrics:
    def __init__(self):
        self.lock = threading.Lock()
        self.values: dict[tuple[str, tuple], float] = {}
        self.histograms: dict[tuple[str, tuple], list[float]] = {}
        self.bounds: dict[str, list[float]] = {}
        self.kinds: dict[str, str] = {}

    def inc(self, name: str, by: float = 1, **labels) -> None:
        with self.lock:
            self.kinds[name] = "counter"
            key = name, tuple(sorted(labels.items()))
            self.values[key] = self.values.get(key, 0) + by

    def set(self, name: str, value: float, **labels) -> None:
        with self.lock:
            self.kinds[name] = "gauge"
            self.values[name, tuple(sorted(labels.items()))] = value

    def observe(self, name: str, value: float, bounds: Iterable[float], times: int = 1, **labels) -> None:
        """value, seen so many times, into a histogram with these upper bounds."""
        with self.lock:
            self.kinds[name], self.bounds[name] = "histogram", list(bounds)
            h = self.histograms.setdefault((name, tuple(sorted(labels.items()))), [0.0] * (len(self.bounds[name]) + 2))
            for i, b in enumerate(self.bounds[name]):
                h[i] += times * (value <= b)
            h[-2] += times
            h[-1] += times * value

    def get(self, name: str, **labels) -> float:
        return self.values.get((name, tuple(sorted(labels.items()))), 0)

    def count(self, name: str, **labels) -> float:
        """Observations of a histogram."""
        h = self.histograms.get((name, tuple(sorted(labels.items()))))
        return h[-2] if h else 0

    def text(self) -> str:
        def line(name, labels, value):
            inner = ",".join(f'{k}="{_escaped(v)}"' for k, v in labels)
            return f"{name}{{{inner}}} {value:g}" if inner else f"{name} {value:g}"

        with self.lock:
            out = []
            for name in sorted(self.kinds):
                out.append(f"# TYPE {name} {self.kinds[name]}")
                out += [line(n, labels, v) for (n, labels), v in sorted(self.values.items()) if n == name]
                for (n, labels), h in sorted(self.histograms.items()):
                    if n == name:
                        out += [line(f"{n}_bucket", (*labels, ("le", f"{b:g}")), c) for b, c in zip(self.bounds[n], h, strict=False)]
                        out += [line(f"{n}_bucket", (*labels, ("le", "+Inf")), h[-2]), line(f"{n}_count", labels, h[-2]), line(f"{n}_sum", labels, h[-1])]
            return "\n".join(out) + "\n"


def _escaped(value) -> str:
    return str(value).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
