"""Plan of joining fragments, some at a time, until one file is left."""

from __future__ import annotations

LIMIT = 32


def compose_plan(fragments: list[str], output: str, temp: str, limit: int = LIMIT) -> list[tuple[str, list[str]]]:
    """Steps (target, sources) of at most `limit` sources each; the last is (output, [one file]), a move."""
    if not fragments:
        raise ValueError("the manifest lists no fragments")
    steps, level, now = [], 0, list(fragments)
    while len(now) > 1:
        made = []
        for i in range(0, len(now), limit):
            target = f"{temp}/round{level}-{i // limit}"
            steps.append((target, now[i : i + limit]))
            made.append(target)
        now, level = made, level + 1
    return [*steps, (output, now)]
