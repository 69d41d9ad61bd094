"""Conversations damaged, repaired and put in a trie by plain Python, one at a time."""

import hashlib
import re
import zlib
from collections import defaultdict

WHITE = " \t\n\x0b\f\r"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def ordered(rows, blank=" "):
    """Rows by conversation, in order of turn (nulls first), role and text."""
    by = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by[conv_id].append((turn, blank if role is None else role, blank if text is None else text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode())
    return {c: sorted(some, key=key) for c, some in by.items()}


def damage(rows):
    for conv_id, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{show(conv_id)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        for _ in range({0: 0, 3: 2}.get(fault, 1)):
            yield conv_id, turn, role, text


def fault_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        out.append(
            "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit, repaired turns) by dynamic programming over the rows and the initials so far, which are only told
    apart by what may follow them."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserts(best):
        for _ in range(3):
            for last, (cost, audit, turns) in list(best.items()):
                for r in follow[last]:
                    if r != "s":
                        better(best, r, (cost + 2, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[r], ""))))

    def better(best, state, value):
        if state not in best or value[:2] < best[state][:2]:
            best[state] = value

    best = {"": (0, "", ())}
    inserts(best)
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for last, (cost, audit, turns) in best.items():
            better(new, last, (cost + 3, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                cost += fault == "truncated"
                if role and role[0] in follow[last]:
                    better(new, role[0], (cost, audit + "K", (*turns, (role, text))))
                for r, name in (("u", "user"), ("a", "assistant")):
                    if r in follow[last]:
                        better(new, r, (cost + 2, audit + "R", (*turns, (name, text))))
        inserts(new)
        best = new
    found = min((v for s, v in best.items() if s in ("", "a")), key=lambda v: v[:2])
    assert GRAMMAR.match("".join(role[0] for role, _ in found[2]))
    return found


def repaired(rows):
    """One tuple per conversation of the rows as they are before the damage."""
    rows = list(rows)
    by = ordered(damage(rows))
    for conv_id in {r[0] for r in rows}:
        some = by.get(conv_id, [])
        faults = fault_of(some)
        turns = [t for t, _, _ in some if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(some[:-1], some[1:])]
        cost, audit, out = cheapest(some, faults) if some else (0, "", ())
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        yield (
            conv_id, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha,
        )
