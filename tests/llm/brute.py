"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def shingles(text: str | None, size: int = 5) -> set:
    found = words(text)
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def jaccard_components(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, int]]:
    """(doc_id, n_shingles, component_id) of each row, comparing every pair of documents."""
    sets = [shingles(text) for _, text in rows]
    component = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * (len(a) + len(sets[j]) - common) and component[i] != component[j]:
                old, new = component[i], component[j]
                component = [new if c == old else c for c in component]
    least: dict[int, int] = {}
    for (doc_id, _), c in zip(rows, component, strict=True):
        least[c] = min(doc_id, least.get(c, doc_id))
    return sorted((r[0], len(s), least[c]) for r, s, c in zip(rows, sets, component, strict=True))
