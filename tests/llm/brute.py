"""Plain-Python versions of the operators' results, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

GAP = re.compile(r"[^ \t-\r]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return GAP.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(docs, window=13):
    """{doc_id: (n_words, n_removed, sha256 of the kept words)}; docs: [(doc_id, text)]."""
    first = {}
    for i, text in docs:
        w = words(text)
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, text in docs:
        w = words(text)
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        out[i] = (len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def overlaps(docs, items, ngram=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(FOLD))
    holders = defaultdict(set)
    for item, text in items:
        w = split(text)
        n = min(ngram, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            holders[tuple(w[p:p + n])].add("" if item is None else str(item))
    sizes = {len(k) for k in holders}
    out = {}
    for i, text in docs:
        w = split(text)
        hit, met = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if got := holders.get(tuple(w[p:p + n])):
                    hit.update(range(p, p + n))
                    met |= got
        out[i] = (len(w), len(hit), len(met), sha(",".join(sorted(met))), bool(hit))
    return out


def shingles(text, k):
    w = words((text or "").translate(FOLD))
    return {tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near(docs, k, percent=80):
    """{doc_id: (n_shingles, component_id, kept)}: every pair that shares a shingle is compared."""
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    shared = Counter()
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def quality_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    at = defaultdict(list)
    for p in range(len(w) - 2):
        at[tuple(w[p:p + 3])].append(p)
    covered = {q for ps in at.values() if len(ps) > 1 for p in ps for q in (p, p + 1, p + 2)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def line_dedup(docs, size=3):
    """{doc_id: (n_lines, n_removed, text)}."""
    strip = lambda x: x.strip(" \t\n\v\f\r")
    rows, first = {}, {}
    for i, text in docs:
        lines = (text or "").split("\n")
        full = [(p, strip(x)) for p, x in enumerate(lines) if strip(x)]
        rows[i] = (lines, full)
        for at in range(len(full) - size + 1):
            key = tuple(x for _, x in full[at:at + size])
            first[key] = min(first.get(key, (i, at)), (i, at))
    out = {}
    for i, text in docs:
        lines, full = rows[i]
        gone = set()
        for at in range(len(full) - size + 1):
            if first[tuple(x for _, x in full[at:at + size])] != (i, at):
                gone.update(p for p, _ in full[at:at + size])
        kept = "\n".join(x for p, x in enumerate(lines) if p not in gone) if text is not None else None
        out[i] = (len(full), len(gone), kept)
    return out


def chat(rows):
    """{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}; rows: [(conv_id, turn, role, text)]."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def warc(pages, min_bytes=0):
    """{page_id: (payload_bytes, payload_digest, record_type, refers_to)}; pages: [(page_id, html)]."""
    first = {}
    for i, html in pages:
        data = (html or "").encode()
        first[data] = min(first.get(data, i), i)
    out = {}
    for i, html in pages:
        data = (html or "").encode()
        f = first[data] if len(data) >= min_bytes else i
        out[i] = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                  "response" if f == i else "revisit", None if f == i else f)
    return out


def quality_kept(docs, spread=3, min_group=100):
    """{doc_id: kept}; docs: [(doc_id, text, lang, source)].  Fences from fully sorted rates."""
    base = {i: quality_base(t) for i, t, _, _ in docs}
    rates, groups = {}, defaultdict(list)
    for i, t, lang, source in docs:
        n, chars, symbols, dup, repeat, failed = base[i]
        if not failed:
            n_lines = sum(1 for x in t.split("\n") if words(x))
            rates[i] = (1000 * symbols // chars, 1000 * repeat // n, 1000 * dup // n_lines, 100 * chars // n)
            for key in ((lang, source), (lang,), ()):
                groups[key].append(rates[i])
    margins = (50, 150, 200, 150)
    out = {}
    for i, _, lang, source in docs:
        out[i] = i in rates
        if i in rates:
            rows = next((g for g in (groups[lang, source], groups[lang,]) if len(g) >= min_group), groups[()])
            for r, (mine, margin) in enumerate(zip(rates[i], margins)):
                at = sorted(x[r] for x in rows)
                low, high = at[-(-len(at) // 4) - 1], at[-(-3 * len(at) // 4) - 1]
                floor = low - spread * (high - low) - 100 if r == 3 else -1
                out[i] &= floor <= mine <= high + spread * (high - low) + margin
    return out


def cut_overlaps(docs, items, ngram=10):
    """[(doc_id, text)] left: documents of which over half is hit go, hit runs are cut from the others."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    keys = set()
    for _, text in items:
        w = word.findall((text or "").translate(FOLD))
        n = min(ngram, len(w))
        keys |= {tuple(w[p:p + n]) for p in range(len(w) - n + 1)} if w else set()
    out = []
    for i, text in docs:
        found = list(word.finditer((text or "").translate(FOLD)))
        w = [m.group() for m in found]
        hit = sorted({q for n in {len(k) for k in keys} for p in range(len(w) - n + 1) if tuple(w[p:p + n]) in keys
                      for q in range(p, p + n)})
        if 2 * len(hit) > len(w):
            continue
        kept, begin = [], 0
        for p in hit:
            if p - 1 not in hit:
                kept.append(text[begin:found[p].start()])
            begin = found[p].end()
        out.append((i, "".join(kept) + text[begin:] if hit else text))
    return out


def repair(turns):
    """{conv_id: contract values of op11}; turns: [(conv_id, turn, role, text)]."""
    import zlib

    convs = {c: [] for c, *_ in turns}
    known = lambda x: " " if x is None else str(x)
    for c, turn, role, text in turns:
        role, text, kind = known(role), known(text), zlib.crc32(f"{known(c)}:{known(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn is not None, turn or 0, "user" if kind == 4 else role, text)
        convs[c] += [row] * (2 if kind == 3 else 1)
    return {c: repair_one([(t if has else None, r, x) for has, t, r, x in sorted(rows)]) for c, rows in convs.items()}


def repair_one(rows):
    """rows (turn, role, text) in order; a table filled row by row instead of a search."""
    legal = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turn = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    step = lambda q: legal[q, turn[q][0]]

    def inserts(best):
        for _ in range(4):
            for q in list(best):
                cost, audit, out = best[q]
                new = (cost + 2, audit + "I", out + (f"{turn[q]}:",))
                best[step(q)] = min(best.get(step(q), new), new)
        return best

    best = inserts({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for q, (cost, audit, out) in best.items():
            options = [(q, (cost + 3, audit + "D", out))]
            if fault not in ("b", "d"):
                late = fault == "t"
                options.append((step(q), (cost + 2 + late, audit + "R", out + (f"{turn[q]}:{text}",))))
                if (q, role[:1]) in legal:
                    options.append((legal[q, role[:1]], (cost + late, audit + "K", out + (f"{role}:{text}",))))
            for to, value in options:
                new[to] = min(new.get(to, value), value)
        best = inserts(new)
    cost, audit, out = min(best[q] for q in (0, 3) if q in best)
    turns = {t for t, *_ in rows if t is not None}
    roles = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            illegal, cost, audit, sha("\n".join(out)))


def line_tokens(docs, encode, spell):
    """[(doc_id, section, n_chars, n_tokens, n_crossing)], sorted; docs: [(doc_id, text)], spell: a token's bytes."""
    out = []
    for i, text in docs:
        text = text or ""
        owner_of, at = [], 0
        lines = text.split("\n")
        for k, line in enumerate(lines):
            owner_of += [k] * len(line) + [-1] * (k < len(lines) - 1)
        counts = {k: [owner_of.count(k) if len(lines) < 50 else 0, 0, 0] for k in range(-1, len(lines))}
        if len(lines) >= 50:
            for k, n in Counter(owner_of).items():
                counts[k][0] = n
        chars = [c for c, x in enumerate(text) for _ in x.encode()]
        for token in encode(text):
            size = len(spell(token))
            held = Counter(owner_of[c] for c in set(chars[at:at + size]))
            at += size
            best = min((k for k in held if k >= 0), key=lambda k: (-held[k], k), default=-1)
            counts[best][1] += 1
            counts[best][2] += best >= 0 and len(held) > 1
        out += [(i, k, *v) for k, v in counts.items()]
    return sorted(out)


def boundaries(lengths, buckets):
    """Upper lengths of the buckets with the least padding, from every split of the sorted distinct lengths."""
    n = Counter(lengths)
    top = sorted(n)
    count, mass = [0], [0]
    for x in top:
        count.append(count[-1] + n[x])
        mass.append(mass[-1] + n[x] * x)
    waste = lambda i, j: top[j - 1] * (count[j] - count[i]) - (mass[j] - mass[i])
    best = [(waste(0, j) if j else 0, (top[j - 1],) if j else ()) for j in range(len(top) + 1)]
    for b in range(2, min(buckets, len(top)) + 1):
        last = best
        best = last[:b] + [None] * (len(top) + 1 - b)
        for j in range(b, len(top) + 1):
            cost, i = min((last[i][0] + waste(i, j), i) for i in range(b - 1, j))
            best[j] = (cost, last[i][1] + (top[j - 1],))
    return list(best[-1][1])
