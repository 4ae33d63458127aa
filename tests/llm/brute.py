"""Plain restatements of the operators, for small tables of (doc_id, text)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PII = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def words(text):
    return WORDS.findall(text or "")


def repeated_words(rows, k=50):
    first = {}
    for d, t in sorted(rows):
        w = words(t)
        for i in range(len(w) - k + 1):
            first.setdefault(tuple(w[i : i + k]), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = bytearray(len(w))
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone[i : i + k] = b"\1" * k
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return out


def repeated_bytes(rows, k=400):
    count = Counter()
    rows = [(d, (t or "").encode()) for d, t in rows]
    for _, b in rows:
        count.update(b[i : i + k] for i in range(len(b) - k + 1))
    out = []
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if count[b[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(rows, percent=75):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    for d, s in sets.items():
        both = Counter(e for x in s for e in where[x] if e < d)
        for e, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = top(d), top(e)
                parent[max(a, b)] = min(a, b)
    return [(d, len(sets[d]), top(d)) for d, _ in rows]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def private(text):
    """(start, kind, end) of valid base spans."""
    out = []
    for k, pattern in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def sanitize(text):
    out, at = "", 0
    for a, k, b in private(text):
        if a >= at:
            out += text[at:a] + ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>")[k]
        at = max(at, b)
    return None if text is None else out + text[at:]


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = [0] * len(w)
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            again[i : i + 5] = [1] * 5
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    n = sum(again)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n, len(w) < 10 or 100 * n > 20 * len(w)


def prefix_nodes(rows):
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    full, members, below = {}, defaultdict(list), defaultdict(list)
    for c, v in own.items():
        rest = abs(c) % 5
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = tuple((own.get(c - rest if c > 0 else c + rest, [])[:h] if rest else v[:h]) + v[h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    for x in members:
        if x:
            below[x[:-1]].append(x)
    leaves, saved, out = {}, {}, []
    for x, m in sorted(members.items(), key=lambda i: -len(i[0])):
        leaves[x] = sum(leaves[y] for y in below[x]) if below[x] else 1
        saved[x] = sum(saved[y] for y in below[x]) + ((len(m) - 1) * len(x[-1][1].encode()) if x else 0)
        ends = sorted(c for c in m if len(full[c]) == len(x))
        out.append((min(m), len(x), min(members[x[:-1]]) if x else None, len(m), len(below[x]), leaves[x], saved[x], sha(",".join(map(str, ends)).encode())))
    return out


def variants(rows, drop=199):
    """word, form, root, n, n_near and form_n."""
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += len(run) > 5
    n = {w: c for w, c in n.items() if c >= 5}
    parts, near, form = defaultdict(set), {w: set() for w in n}, {}
    for w in n:
        for i in range(len(w)):
            parts[i, w[:i] + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in n:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for same in parts.values():
        for w in same:
            near[w] |= same - {w}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return [(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n]
