"""The results of the operators by the plainest means, on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def op2(rows, length=50):
    """rows: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, sha256)."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w not in first or doc < first[w]:
                first[w] = doc
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shingle_set(text, n, lower=True):
    w = [x.lower() for x in words(text)]  # bytes.lower() touches A-Z only
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def op9(rows, n=4, percent=80):
    sets = [shingle_set(t, n) for _, t in rows]
    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        near = Counter(j for x in s for j in held[x] if j > i)
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b, key=lambda k: rows[k][0])] = min(a, b, key=lambda k: rows[k][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        c = rows[find(i)][0]
        out.append((doc, len(sets[i]), c, doc == c))
    return sorted(out)


def op5_base(rows):
    out = []
    for doc, text in rows:
        text = text or ""
        w = [x.decode() for x in words(text)]
        lines, seen, dup = text.split("\n"), set(), 0
        for line in lines:
            if words(line):
                dup += line in seen
                seen.add(line)
        tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        count, marked = Counter(tri), set()
        for i, t in enumerate(tri):
            if count[t] > 1:
                marked |= {i, i + 1, i + 2}
        failed = len(w) < 50 or 100 * len(marked) > 50 * len(w)
        out.append((doc, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(marked), failed))
    return sorted(out, key=repr)


def op10(rows, path, capacity=2048):
    """(doc_id, piece, start, length, crc) of each piece."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    out = []
    for doc, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            raw = b"".join(i.to_bytes(4, "little") for i in part)
            out.append((doc, k, s, len(part), zlib.crc32(raw)))
    return sorted(out)


def best_fit_decreasing(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        room = [b for b in range(len(bins)) if bins[b] >= n]
        if room:
            bins[min(room, key=lambda b: bins[b])] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


def targets(sizes, weights=(1, 2, 3), most=3):
    """Water filling, round by round; sizes in the order of sources."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, got, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        rest = total - sum(got[i] for i in range(len(sizes)) if i not in free)
        share = sum(w[i] for i in free)
        over = {i for i in free if rest * w[i] / share > most * sizes[i]}
        for i in free:
            got[i] = float(most * sizes[i]) if i in over else rest * w[i] / share
        if not over:
            break
        free -= over
    return got


def _said(lines):
    """The own lines (bytes) of runs that adjoin no fixed side of a frequent line ([before, after] is a line)."""
    own = []
    for frequent, run in groupby(lines, key=lambda x: isinstance(x, list)):
        own.append((frequent, list(run)))
    said = []
    for i, (frequent, run) in enumerate(own):
        above = i > 0 and own[i - 1][1][-1][1]
        below = i + 1 < len(own) and own[i + 1][1][0][0]
        if not frequent and not above and not below:
            said += run
    return tuple(sorted(said))


def op5_verdict(rows, max_docs=10):
    """{doc_id: (kept, text without boilerplate)} for rows (doc_id, text, source) with distinct doc_ids."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"
    table = str.maketrans(up, low)
    norm = {d: [b" ".join(words(line.translate(table))) for line in (t or "").split("\n")] for d, t, _ in rows}
    held, around = defaultdict(set), defaultdict(lambda: (set(), set()))
    for d, _, s in rows:
        full = [None, *filter(None, norm[d]), None]
        for i in range(1, len(full) - 1):
            held[s, full[i]].add(d)
            for side, j in ((0, i - 1), (1, i + 1)):
                around[s, full[i]][side].add((d, full[j]))
    fixed, lined = {}, {}
    for k, docs in held.items():
        if len(docs) > max_docs:
            counts = [Counter(x for _, x in side) for side in around[k]]
            fixed[k] = [2 * max(c.values()) >= sum(c.values()) for c in counts]
            lined[k] = [any(2 * n >= sum(c.values()) for x, n in c.items() if x) for c in counts]
    component = {r[0]: r[2] for r in op9([(d, t) for d, t, _ in rows], 5)}
    told = {d: _said([lined.get((s, x), x) for x in norm[d] if x]) or component[d] for d, _, s in rows}
    bad = {k for k, sides in fixed.items() if not all(sides) or len({told[d] for d in held[k]}) > max_docs}
    base = {r[0]: r for r in op5_base([(d, t) for d, t, _ in rows])}
    out = {}
    for d, t, s in rows:
        lines = (t or "").split("\n")
        gone = [i for i, line in enumerate(norm[d]) if (s, line) in bad]
        n = base[d][1]
        left = n - sum(len(words(lines[i])) for i in gone)
        depleted = left < n and (left < 25 or left < 0.3 * n)
        text = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t
        out[d] = (not base[d][6] and not depleted, text)
    return out


def cut_repeats(rows, length=50):
    """{doc_id: text left} with removed runs shrunk to whole characters."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            first[w] = min(doc, first.get(w, doc))
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        kept, at = [], 0
        for c in text or "":
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        out[doc] = text if not any(gone) else "".join(kept)
    return out


def op11(rows):
    """rows: (doc_id, text) -> (doc_id, keep_id, group_size, kept, sha256)."""
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for body, members in groups.items():
        digest, best = hashlib.sha256(body.encode()).hexdigest(), min(members)
        out += [(rows[i][0], rows[best[3]][0], len(members), i == best[3], digest) for *_, i in members]
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lexical_terms(text):
    return [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def op13(rows, items, k=10):
    """rows: (doc_id, text), items: (item_id, text) -> (item_id, rank, doc_id, score)."""
    counts = [Counter(lexical_terms(t)) for _, t in rows]
    sizes = [sum(c.values()) for c in counts]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    asked = defaultdict(set)
    for who, text in items:
        asked[who].update(lexical_terms(text))
    out = []
    for who, terms in asked.items():
        scored = []
        for (doc, _), c, size in zip(rows, counts, sizes):
            score = 0
            for t in terms:
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * size * n // length)))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(who, i + 1, doc, -s) for i, (s, _, doc) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def op12(rows, ids):
    """rows: (conv_id, turn, role, text) after damage -> the contract's row per id, by trying edits turn by turn."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    after_new = {"": ("user", "u"), "s": ("user", "u"), "u": ("assistant", "a"), "a": ("user", "u")}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        by[conv].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), turn, text))
    out = []
    for conv in ids:
        mine = sorted(by.get(conv, []))
        seen, faults = set(), []
        for _, _, role, _, _, text in mine:
            said = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [m[2][:1] for m in mine]
        turns = {m[4] for m in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        best = {"": (0, "", [])}

        def inserted(at):
            at = dict(at)
            for _ in range(3):
                for state, (cost, audit, lines) in list(at.items()):
                    role, to = after_new[state]
                    way = (cost + 5, audit + "I", lines + [f"{role}:"])
                    if to not in at or way[:2] < at[to][:2]:
                        at[to] = way
            return at

        for (_, _, role, _, _, text), fault, initial in zip(mine, faults, initials):
            new = {}
            for state, (cost, audit, lines) in inserted(best).items():
                extra = 5 if fault == "t" else 0
                ways = [(state, (cost + 2, audit + "D", lines))]
                if fault in ("", "t"):
                    if (state, initial) in after:
                        ways.append((after[state, initial], (cost + extra, audit + "K", lines + [f"{role}:{text}"])))
                    name, to = after_new[state]
                    ways.append((to, (cost + 1 + extra, audit + "R", lines + [f"{name}:{text}"])))
                for to, way in ways:
                    if to not in new or way[:2] < new[to][:2]:
                        new[to] = way
            best = new
        cost, audit, lines = min((w for s, w in inserted(best).items() if s in ("", "a")), key=lambda w: w[:2])
        counts = [faults.count(f) for f in "bdt"]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)
