"""Plain versions of the contracts, for small inputs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, rows, parts=3):
    """Documents of (doc_id, text) pairs or longer tuples."""
    full = [tuple(r) + (("en", "s0", None if r[1] is None else len(r[1])) if len(r) == 2 else ()) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def corpus(seed=1, n=60, vocabulary=400, longest=160):
    """Random prose with exact and near copies, shared passages, nulls, empty
    and very short texts, repeated words and other alphabets."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    passages = [[r.choice(vocab) for _ in range(70)] for _ in range(3)]
    texts = []
    for i in range(n):
        ws = [r.choice(vocab) for _ in range(r.randint(1, longest))]
        kind = i % 6
        if kind == 1 and texts:
            ws = r.choice(texts)[:]
        elif kind == 2 and texts:
            ws = r.choice(texts)[:]
            for _ in range(1 + len(ws) // 40):
                ws[r.randrange(len(ws))] = r.choice(vocab)
        elif kind == 3:
            at = r.randrange(len(ws))
            ws[at:at] = r.choice(passages)
        elif kind == 4 and texts:
            a, b = r.choice(texts), r.choice(texts)
            ws = a[:len(a) // 2] + b[len(b) // 3:]
        texts.append(ws or ["x"])
    rows = [(i, "".join(w + r.choice([" ", " ", "  ", "\n", "\t"]) for w in ws)) for i, ws in enumerate(texts)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "a " * 130), (n + 4, "A b A b " * 40), (n + 5, "日本 語 " * 60), (n + 6, "one")]
    return rows


def repeats(rows, window=50):
    """(doc_id, n_words, n_removed, kept_sha256) of the op2 contract."""
    first = defaultdict(lambda: float("inf"))
    for i, t in rows:
        if i is not None:
            w = plain_words(t)
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first[key], i)
    out = []
    for i, t in rows:
        w = plain_words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def shingles(text, n=5):
    w = plain_words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(rows, num=75, den=100):
    """(doc_id, n_shingles, component_id) of the op1 contract."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if s and t and den * len(s & t) >= num * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def base_stats(text):
    w = plain_words(text)
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    count = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if count[tuple(w[k:k + 5])] > 1:
            covered.update(range(k, k + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(rows, items, size=13):
    """Rows of the op8 contract."""
    windows = defaultdict(set)
    for item, t in items:
        w = letter_words(t)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows[tuple(w[k:k + size])].add(item)
    out = []
    for i, t in rows:
        w = letter_words(t)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k:k + n])):
                    found |= got
                    hit.update(range(k, k + n))
        found.discard(None)
        ids = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def byte_repeats(rows, size=400):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of the op4 contract."""
    count = Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, d in data:
        count.update(d[k:k + size] for k in range(len(d) - size + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - size + 1):
            if count[d[k:k + size]] > 1:
                gone[k:k + size] = b"\1" * size
        spans = sum(gone[k] and (not k or not gone[k - 1]) for k in range(len(d)))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(d, gone) if not g)).hexdigest()))
    return sorted(out, key=str)
