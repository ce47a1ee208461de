"""Plain versions of the operators for small inputs, and tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

EXTRA = "row string, copies long, size double, tie string, score string, n long, number long, tokens string, kept_id long, rate string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def words(text):
    return (text or "").encode().split()


def documents(seed: int = 3, n: int = 60) -> list[tuple]:
    """Copies, near copies, shared passages, NULLs, empty, odd and very long texts, repeated rows."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeéñ") for _ in range(draw.randint(2, 6))) for _ in range(400)]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(60, 160))) for _ in range(n)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(70))
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(100 + i, texts[i]) for i in range(6)]  # exact copies
    near = texts[7].split()
    for i in range(5):
        changed = list(near)
        changed[draw.randrange(len(changed))] = f"changed{i}"
        rows.append((200 + i, " ".join(changed)))
    rows += [(300 + i, f"{texts[10 + i]} {passage} {texts[20 + i]}") for i in range(5)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "one"), (404, "one two"), (405, "ONE TWO"), (406, "x\u00a0y \x1c z\u0085w , . \U0001f600 ßẞ")]
    rows += [(500, " ".join(vocabulary * 40)), (501, "a" * 100_000), (502, "same " * 5_000)]
    rows += [(None, texts[0]), (None, None), (None, texts[30]), (600, texts[40]), (600, texts[40]), (600, texts[41])]
    filled = [(i, t, None if k % 5 == 0 else "en", [None, "s", "S", "é", "hot", "hot", "hot"][k % 7], None) for k, (i, t) in enumerate(rows)]
    return [(*row, "r", 5, 1.5, "t", "x", 7, None, "y", 9, None) for row in filled]


def duck(name_rows: dict, sql: str):
    """Rows of an SQL text over pyarrow tables."""
    import duckdb

    connection = duckdb.connect()
    for name, table in name_rows.items():
        connection.register(name, table)
    return connection.execute(sql).fetchall()


def components(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text), rows judged one by one."""
    sets = []
    for _, text in rows:
        own = (text or "").encode().lower().split()
        sets.append(set(zip(own, own[1:], own[2:])) if len(own) >= 3 else ({tuple(own)} if own else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 90 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(rows):
        r = root(i)
        if doc_id is not None and (least[r] is None or doc_id < least[r]):
            least[r] = doc_id
    return [(rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))]


def repeats(rows, window=50):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    first = {}
    for doc_id, text in rows:
        own = words(text)
        for p in range(len(own) - window + 1):
            gram = tuple(own[p : p + window])
            if doc_id is not None:
                first[gram] = min(first.get(gram, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        own, gone = words(text), set()
        if doc_id is not None:
            for p in range(len(own) - window + 1):
                if first[tuple(own[p : p + window])] < doc_id:
                    gone.update(range(p, p + window))
        kept = b" ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def unigrams(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)."""
    counts = Counter()
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    for (_, text), out in zip(rows, held):
        if not out:
            counts.update([*words(text), b""])
    n, v = sum(counts.values()), len(counts)
    result = []
    for (doc_id, text), out in zip(rows, held):
        own = [*words(text), b""]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        result.append((doc_id, out, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    return result


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
