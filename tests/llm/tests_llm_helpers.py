"""Brute-force versions shared by several test files."""
import hashlib
import struct

import xxhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(prints, reach):
    """prints: list of (id, unsigned fingerprint); smallest id reachable."""
    low = [i for i, _ in prints]
    while True:
        new = [min([low[j] for j, (_, g) in enumerate(prints) if (f ^ g).bit_count() <= reach]) for _, f in prints]
        if new == low:
            return low
        low = new


def slow_targets(size, most=3):
    """Excess over `most` times the size goes to the others by weight."""
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, target, free = sum(size.values()), {}, set(names)
    while free:
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= most * size[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: float(most * size[s]) for s in over}
        free -= over
    return target


def digest(tokenizer, text):
    """(number of ids, SHA-256 of ids, SHA-256 of the decoded text)."""
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    back = tokenizer.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())
