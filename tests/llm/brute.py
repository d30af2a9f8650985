"""Plain single-machine versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    own, text = words(text), text or ""
    places = {}
    for i in range(len(own) - 2):
        places.setdefault(tuple(own[i : i + 3]), []).append(i)
    covered = {i + d for at in places.values() if len(at) > 1 for i in at for d in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def shingle_set(text, width=5):
    own = words(text, True)
    return {tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1))} if own else set()


def jaccard_components(rows):
    """(set size, component) for each (doc_id, text)."""
    sets = {doc_id: shingle_set(text) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {doc_id: (len(sets[doc_id]), find(doc_id)) for doc_id in sets}


def lm_scores(rows, backoff=0.4):
    """(doc_id, words, known pairs, log10 score), with the document's own counts taken off."""
    docs = [words(text, True) for _, text in rows]
    one, two = Counter(), Counter()
    for own in docs:
        one.update(own)
        two.update(zip(own, own[1:]))
    total, out = sum(one.values()), []
    for (doc_id, _), own in zip(rows, docs):
        my_one, my_two = Counter(own), Counter(zip(own, own[1:]))
        score, known = 0.0, 0
        for i, word in enumerate(own):
            pair = (own[i - 1], word)
            if i and two[pair] > my_two[pair]:
                score += math.log10((two[pair] - my_two[pair]) / (one[own[i - 1]] - my_one[own[i - 1]]))
                known += 1
                continue
            n = one[word] - my_one[word]
            score += math.log10(n / total) if n else math.log10(backoff / total)
            score += math.log10(backoff) if i else 0
        out.append((doc_id, len(own), known, score))
    return out


def top_k(rows, k=10):
    usable = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for query, q in usable:
        if query % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in usable if i != query)
        out += [(query, rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def spelling_counts(rows, min_letters=6, min_count=5, drop_every=199):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_letters:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_groups(counts, ratio=5):
    """(word, form, root, n, n_near, form_n), by deletion neighbourhoods."""
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault(w[:i] + "*" + w[i + 1 :], set()).add(w)
    near = {w: set() for w in counts}
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for w in counts:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def collocations(rows, min_count=10, top=2000, covered=50):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(own)
            for size in (1, 2, 3):
                f.update((lang, tuple(own[i : i + size])) for i in range(len(own) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    longest = Counter()
    for (lang, w), a in candidates.items():
        if len(w) == 3:
            for inner in ((lang, w[:2]), (lang, w[1:])):
                longest[inner] = max(longest[inner], a)
    out = []
    for (lang, w), a in candidates.items():
        if 100 * longest[(lang, w)] >= covered * a:
            continue
        cuts = [(1000000 * a * a // (f[(lang, w[:k])] * f[(lang, w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[(lang, w[:k])], f[(lang, w[k:])]))
    ranks, found = Counter(), set()
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= top:
            found.add((lang, ranks[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return found


def remove_repeats(rows, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, sha of what is kept) of (doc_id, text) rows."""
    data = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in data:
        gone, until = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                for j in range(max(i, until), i + length):
                    gone[j] = 1
                until = i + length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(t)))
        out.append((doc_id, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def outlier_distances(rows, least=20, consistency=2.11):
    """Squared distance of each document (id, lang, source, text) that passes the base rule from its group's tightest half."""
    scales = np.diag(np.square([0.1, 0.03, 0.05, 0.1]))
    points, groups = {}, defaultdict(list)
    for doc_id, lang, source, text in rows:
        n, chars, symbols, lines, repeats = statistics(text)
        if n < 50 or 100 * repeats > 50 * n:
            continue
        points[doc_id] = np.array([math.log(chars / n), (symbols / chars) ** 0.5, (lines / n) ** 0.5, (repeats / n / (1 + n / 10_000)) ** 0.5])
        for key in ((lang, source), (lang,), ()):
            groups[key].append(doc_id)

    def distances(x, fit):
        off = x - fit[0]
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(fit[1]), off)

    def estimate(x):
        best = None
        whole = x.mean(axis=0), consistency * np.cov(x.T, bias=True) + scales
        for fit in (whole, (np.median(x, axis=0), scales)):
            for _ in range(50):
                half = x[np.argsort(distances(x, fit), kind="stable")[: (len(x) + 1) // 2]]
                fit = half.mean(axis=0), consistency * np.cov(half.T, bias=True) + scales
            det = np.linalg.det(fit[1])
            if best is None or det < best[0]:
                best = det, fit
        return best[1]

    fits, found = {}, {}
    for doc_id, lang, source, _ in rows:
        if doc_id in points:
            key = next((k for k in ((lang, source), (lang,)) if len(groups[k]) >= least), ())
            if key not in fits:
                fits[key] = estimate(np.array([points[i] for i in groups[key]]))
            found[doc_id] = float(distances(points[doc_id][None], fits[key])[0])
    return found
