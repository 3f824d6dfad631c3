"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pack(texts):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at, rest = 0, len(ids)
        while rest:
            n = min(1024, 1 << (rest.bit_length() - 1))
            crc = zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())
            out.append((doc_id, at, n, crc, len(ids)))
            at, rest = at + n, rest - n
    return sorted(out, key=repr)


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if w and item is not None:
            n = min(13, len(w))
            for i in range(len(w) - n + 1):
                windows[tuple(w[i : i + n])].add(str(item))
    lengths = {len(x) for x in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                of = windows.get(tuple(w[i : i + n]))
                if of:
                    found |= of
                    hit.update(range(i, i + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def simhash(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs):
    fps = [(d, simhash(t)) for d, t in docs]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[root(b)] = root(a)
    least = defaultdict(list)
    for d, f in fps:
        if d is not None:
            least[root(f)].append(d)
    return sorted(((d, f"{f:016x}", min(least[root(f)], default=None)) for d, f in fps), key=repr)


def secrets(docs):
    assign = re.compile(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.I | re.A,
    )
    out = []
    for doc_id, text in docs:
        text = text or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(1)) >= 8]
        found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
        found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
        spans = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))
        counts = [sum(k == i for _, k, _ in found) for i in range(3)]
        out.append((doc_id, *counts, hashlib.sha256(spans.encode()).hexdigest(), spans))
    return sorted(out, key=repr)
