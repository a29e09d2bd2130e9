"""Stages with requirements and expected outputs; a stage whose outputs are there is skipped."""

from __future__ import annotations

import hashlib
import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Stage:
    name: str
    run: Callable[[dict], None]
    requires: list[str] = field(default_factory=list)
    outputs: list[str] = field(default_factory=list)
    wanted: Callable[[dict], bool] = lambda config: True


def order(stages: list[Stage], targets: list[str]) -> list[Stage]:
    """The targets' stages and what they require, requirements first."""
    by_name, out, state = {s.name: s for s in stages}, [], {}

    def visit(name: str) -> None:
        if state.get(name) == "done":
            return
        if state.get(name) == "open":
            raise ValueError(f"{name} requires itself")
        if name not in by_name:
            raise ValueError(f"there is no stage {name}")
        state[name] = "open"
        for r in by_name[name].requires:
            visit(r)
        state[name] = "done"
        out.append(by_name[name])

    for t in targets:
        visit(t)
    return out


def run(stages: list[Stage], targets: list[str], config: dict, exists: Callable[[str], bool]) -> list[str]:
    """Run in order what isn't done and is wanted; the names of what ran."""
    ran = []
    for s in order(stages, targets):
        if s.wanted(config) and not (s.outputs and all(map(exists, s.outputs))):
            s.run(config)
            ran.append(s.name)
    return ran


def load_config(text: str) -> dict:
    return tomllib.loads(text)


_NONE = object()


def retrieve(config: dict, path: list[str], default=_NONE):
    """A value by its path of keys; an error where it is absent and has no default."""
    at = config
    for k in path:
        if not isinstance(at, dict) or k not in at:
            if default is _NONE:
                raise KeyError(".".join(path))
            return default
        at = at[k]
    return at


def dataset_wanted(dataset: str, config: dict, lists: tuple[str, ...] = ("write_mt_for_datasets", "create_es_index_for_datasets", "write_vcf")) -> bool:
    """Whether any of the lists names the dataset."""
    return any(dataset in retrieve(config, ["workflow", x], []) for x in lists)


def short_hash(ids: list[str]) -> str:
    """Four hex digits that name a set of ids."""
    return hashlib.sha256("".join(sorted(ids)).encode()).hexdigest()[:4]


def family_ids(pedigree: list[tuple[str, str]], families: list[str]) -> tuple[list[str], str]:
    """(sample ids of the families, short name of their set); none is an error. pedigree: (family, sample)."""
    ids = sorted(s for f, s in pedigree if f in set(families))
    if not ids:
        raise ValueError(f"no samples are in families {families}")
    return ids, short_hash(ids)


def family_suffix(ids: list[str], families: list[str]) -> str:
    """What is added to names of outputs that only hold these samples of these families."""
    return f"{len(ids)}_sgs-{len(set(families))}_families-{short_hash(ids)}"


def require_inputs(samples: dict[str, str | None]) -> None:
    """Refuse to run if a sample has no input file."""
    if missing := sorted(s for s, path in samples.items() if not path):
        raise ValueError(f"samples without input: {missing}")


def combiner_action(has_previous: bool, to_add: list[str], to_remove: list[str]) -> str:
    """remove, remove_then_add or add."""
    if has_previous and to_remove:
        return "remove_then_add" if to_add else "remove"
    if to_add:
        return "add"
    raise ValueError("there is nothing to add and nothing to remove")
