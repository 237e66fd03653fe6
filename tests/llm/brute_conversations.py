"""Plain versions of the conversation and neighbour operators."""

import hashlib
import itertools
import math
import re
import zlib

WELL_FORMED = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"
SUFFIX = {"u": "user", "a": "assistant"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turn_hash(role, text):
    return sha(f"{len(role.encode())}:{role}{text}")


def cheapest_by_trying(turns):
    """Least (cost, audit) by trying every edit of every turn and up to two insertions at every place; turns are (initial, must go, cut off)."""
    gaps = [("",), ("u",), ("a",), ("u", "a"), ("a", "u")]
    best = None
    for inserts in itertools.product(gaps, repeat=len(turns) + 1):
        options = []
        for initial, must_go, cut_off in turns:
            extra = 5 * cut_off
            options.append([(2, "D", "")] + ([] if must_go else [(extra, "K", initial), (1 + extra, "R", "u"), (1 + extra, "R", "a")]))
        for edits in itertools.product(*options):
            cost, audit, roles = 0, "", ""
            for i in range(len(turns) + 1):
                new = "".join(inserts[i])
                cost, audit, roles = cost + 5 * len(new), audit + "I" * len(new), roles + new
                if i < len(turns):
                    cost, audit, roles = cost + edits[i][0], audit + edits[i][1], roles + (edits[i][2] if edits[i][1] != "D" else "")
            if WELL_FORMED.match(roles) and all(r in "sua" for r in roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def cheapest_left_to_right(turns):
    """Least (cost, audit) turn by turn over the states of the language: no spans, no grammar."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insertions(at):
        for _ in range(3):
            for (p, role), q in step.items():
                if p in at and role != "s":
                    at[q] = min(at.get(q, (math.inf, "")), (at[p][0] + 5, at[p][1] + "I"))
        return at

    at = insertions({0: (0, "")})
    for initial, must_go, cut_off in turns:
        new = {}

        def put(q, cost, audit, new=new):
            new[q] = min(new.get(q, (math.inf, "")), (cost, audit))

        for p, (cost, audit) in at.items():
            put(p, cost + 2, audit + "D")
            for role, price, name in (() if must_go else ((initial, 0, "K"), ("u", 1, "R"), ("a", 1, "R"))):
                if (p, role) in step:
                    put(step[p, role], cost + price + 5 * cut_off, audit + name)
        at = insertions(new)
    return min(at[q] for q in (0, 3) if q in at)


def repaired(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, lines)} of (conv_id, turn, role, text) rows."""
    convs, out = {}, {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], turn_hash(t[1], t[2])))
        seen, faults, symbols = set(), [0, 0, 0], []
        for _, role, text in turns:
            shown = text.rstrip(SPACE)
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            symbols.append((role[:1], fault in (0, 1), fault == 2))
        numbers = {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = cheapest_left_to_right(symbols)
        kept = sum(e != "D" for e in audit)
        pattern = "s" * (kept % 2) + "ua" * (kept // 2)
        lines, left = [], iter(turns)
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(left)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else SUFFIX[pattern[len(lines)]]}:{text}")
        out[c] = (gaps, *faults, illegal, cost, audit, lines)
    return out


def damaged(rows):
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            yield from [(c, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def trie(rows):
    """The nodes of the rebuilt conversations, as sorted tuples in the order of the query's columns."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], turn_hash(t[1], t[2])[:32]))
        convs[c] = [(role, text) for _, role, text in turns]
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members, kids = {}, {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below, convs_here = kids.get(node, []), members[node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        saved[node] = (len(convs_here) - 1) * words + sum(saved[k] for k in below)
        ends = sorted(c for c in convs_here if len(built[c]) == len(node))
        out.append((min(convs_here), len(node), min(members[node[:-1]]) if node else None, len(convs_here), len(below), leaves[node], saved[node],
                    sha(",".join(map(str, ends)))))
    return sorted(out, key=str)
