"""Stages of a curation run: which ones are picked, what waits for what, and how they are run."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

# The stages in order, and which one needs which.
STAGES = ["ingest", "preprocess", "label", "train", "evaluate", "predict", "chunk", "embed", "enrich"]
NEEDS = [("ingest", "preprocess"), ("preprocess", "label"), ("label", "train"), ("train", "evaluate"), ("train", "predict"), ("evaluate", "predict"), ("predict", "chunk"), ("chunk", "embed"), ("embed", "enrich")]


def picked(wanted: list[str] | None) -> list[str]:
    """The wanted stages in their own order; unknown ones are refused."""
    if wanted is None:
        return list(STAGES)
    unknown = sorted(set(wanted) - set(STAGES))
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(unknown)}")
    return [s for s in STAGES if s in set(wanted)]


def generations(stages: list[str], needs: list[tuple[str, str]] | None = None) -> list[list[str]]:
    """Stages that can run together, in turn; only needs between the given stages count."""
    own = [(a, b) for a, b in (NEEDS if needs is None else needs) if a in stages and b in stages]
    left, out = list(stages), []
    while left:
        ready = [s for s in left if not any(b == s and a in left for a, b in own)]
        if not ready:
            raise ValueError("stages wait for each other")
        out.append(ready)
        left = [s for s in left if s not in ready]
    return out


def longest_path(stages: list[str], needs: list[tuple[str, str]] | None = None) -> int:
    return len(generations(stages, needs))


def run(stages: list[str], work: dict[str, Callable[[], object]], *, parallel: bool = False, done: dict[str, object] | None = None, retries: dict[str, int] | None = None, go_on: set[str] = frozenset()) -> dict[str, object]:
    """Run stages and return their results. What `done` holds (a checkpoint) is not run again; a stage may be tried
    again, and a failure in `go_on` is kept as the result while the rest goes on."""
    results = dict(done or {})

    def one(stage: str) -> object:
        for left in range((retries or {}).get(stage, 0), -1, -1):
            try:
                return work[stage]()
            except Exception as e:
                if left == 0:
                    if stage in go_on:
                        return e
                    raise
        return None

    for group in generations(stages) if parallel else [[s] for s in stages]:
        todo = [s for s in group if s not in results]
        with ThreadPoolExecutor(max(1, len(todo))) as pool:
            results |= dict(zip(todo, pool.map(one, todo), strict=True))
    return results
