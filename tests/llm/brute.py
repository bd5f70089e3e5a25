"""The operators' results by plain definitions, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def shingles(text: str | None, words: int = 5) -> set[tuple[str, ...]]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def near_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component) of rows with distinct ids."""
    sets = {key: shingles(text) for key, text in rows}
    held = defaultdict(list)
    for key, own in sets.items():
        for shingle in own:
            held[shingle].append(key)
    parent = {key: key for key in sets}

    def root(key: int) -> int:
        while parent[key] != key:
            key = parent[key]
        return key

    for key, own in sets.items():
        for other, common in Counter(o for s in own for o in held[s] if o < key).items():
            if 100 * common >= 85 * (len(own) + len(sets[other]) - common):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
    return {key: (len(own), root(key)) for key, own in sets.items()}


def without_repeats(rows: list[tuple[int, str | None]], least: int) -> dict[int, tuple[int, int, int, str]]:
    """doc_id -> (bytes, removed, spans, digest of the rest) of rows with distinct ids."""
    seen: set[bytes] = set()
    out = {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        body = (text or "").encode()
        gone = [False] * len(body)
        for start in range(len(body) - least + 1):
            window = body[start : start + least]
            if window in seen:
                gone[start : start + least] = [True] * least
            seen.add(window)
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def word_list(text: str | None) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def benchmark_hits(text: str | None, items: list[tuple[int, str | None]], window: int = 10) -> tuple[int, int, list[str]]:
    """(words, hit words, ids of the items that occur)"""
    words, hit, found = word_list(text), set(), set()
    for item, item_text in items:
        own = word_list(item_text)
        for at in range(max(len(own) - window, 0) + 1 if own else 0):
            part = own[at : at + window]
            for i in range(len(words) - len(part) + 1):
                if words[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def rebuilt(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """conv_id -> its rebuilt turns, of rows (conv_id, turn, role, text) whose turns do not tie."""
    own: dict[int, list] = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [t[2:] for t in sorted(given)] for conv, given in own.items()}
    out = {}
    for conv, given in turns.items():
        taken = zlib.crc32(str(conv).encode()) % 9
        out[conv] = turns.get(conv - conv % 5, [])[:taken] + given[taken:]
    return out


def trie_nodes(conversations: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    held: dict[tuple, list[int]] = defaultdict(list)
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            held[tuple(turns[:depth])].append(conv)
    under = {path: [0, 0] for path in held}
    children = Counter(path[:-1] for path in held if path)
    for path, members in held.items():
        saved = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for depth in range(len(path) + 1):
            under[path[:depth]][0] += path not in children
            under[path[:depth]][1] += saved
    out = set()
    for path, members in held.items():
        ends = ",".join(str(c) for c in sorted(members) if len(conversations[c]) == len(path))
        parent = min(held[path[:-1]]) if path else None
        out.add((min(members), len(path), parent, len(members), children[path], *under[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def damaged(rows: list[tuple]) -> dict[int | None, list[tuple[int | None, str, str]]]:
    """conv_id -> rows (turn, role, text) after damage, in order."""
    out: dict[int | None, list] = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if what == 4 else role
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        own += [(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    return {conv: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for conv, own in out.items()}


def row_faults(rows: list[tuple[int | None, str, str]]) -> list[str]:
    seen, found = set(), []
    for _, role, text in rows:
        words = text.strip("\x20\t\n\x0b\x0c\r")
        found.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def lightest_repair(rows: list[tuple[int | None, str, str]]) -> tuple[int, str, str]:
    """(cost, audit, digest): all edits tried row by row, the best value kept for each last role."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(best: dict) -> dict:
        for _ in range(8):
            for last, (cost, audit, made) in list(best.items()):
                for to in set(follows[last]) & set(names):
                    value = (cost + 2, audit + "I", (*made, (names[to], "")))
                    if to not in best or value[:2] < best[to][:2]:
                        best[to] = value
        return best

    best = with_inserts({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, row_faults(rows), strict=True):
        new: dict = {}
        for last, (cost, audit, made) in best.items():
            more = fault == "truncated"
            steps = [(last, 3, "D", ())]
            if fault not in ("blank", "duplicate"):
                steps += [(to, 2 + more, "R", ((names[to], text),)) for to in set(follows[last]) & set(names)]
                steps += [(role[:1], int(more), "K", ((role, text),))] if role and role[:1] in follows[last] else []
            for to, price, letter, line in steps:
                value = (cost + price, audit + letter, made + line)
                if to not in new or value[:2] < new[to][:2]:
                    new[to] = value
        best = with_inserts(new)
    cost, audit, made = min((best[q] for q in ("", "a") if q in best), key=lambda v: v[:2])
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()


def repaired(rows: list[tuple]) -> dict[int | None, tuple]:
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)"""
    out = {}
    for conv, own in damaged(rows).items():
        turns = {t for t, _, _ in own if t is not None}
        faults = Counter(row_faults(own))
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, *lightest_repair(own))
    return out
