"""Small tables with every awkward row, and plain versions of the rules to compare with."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside.
CLASH = "size long, anchor string, cid string, comp string, n long, row string, part long, source_size string, kept_text string, spans string"


def rows(seed=1, many=60):
    """Texts with copies, near copies, shared passages, repeated lines, symbols; nulls, blanks, ties, a long one."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage, base = text(60), text(120)
    out = []
    for i in range(many):
        kind = i % 8
        t = text(rng.randint(1, 150))
        if kind == 1:
            t = base if i % 3 else base.upper()
        if kind == 2:
            w = base.split()
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        if kind == 3:
            t = text(20) + "\n" + passage + "\n" + text(5)
        if kind == 4:
            t = "\n".join([text(9)] * rng.randint(1, 4))
        if kind == 5:
            t = " ".join(f"{w}###" for w in t.split())
        out.append((i * 3 - 9, t, ["en", "de", None][i % 3], ["a", "b", "c", None, "ä"][min(4, i % 7)], len(t)))
    out += [
        (1000, None, None, None, None), (1001, "", "en", "a", 0), (1002, " \n\t ", "en", "b", 4), (1003, "one", "en", "a", 3),
        (1004, "one two three", "en", "zero", 13), (1005, "ONE two three", "en", "a", 13), (1006, "", "en", "empty", 0),
        (1007, "x" * 5000, "en", "a", 5000), (1008, "ab " * 3000, "de", "b", 9000), (1009, "日本語 テキスト\u3000é\x1cq", "ja", "a", 12),
        (1010, "<|endoftext|> and <|startoftext|>x don't", "en", "b", 40), (1011, text(4000), "en", "c", None),
        (2000, base, "en", "a", 9), (2000, base, "en", "a", 9), (2001, base + " end", "en", "b", 9),
    ]
    return out


def frame(spark, data, extra=True):
    df = spark.createDataFrame(data, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in CLASH.split(", "))])
    return df.repartition(5)


def sizes(data):
    return [len(WORD.findall(t or "")) for _, t, *_ in data]


def mix_targets(data):
    """Fractions: shares by weight, capped at twice the own size, the excess reshared until none is above."""
    own = defaultdict(int)
    for (_, _, _, s, _), n in zip(data, sizes(data), strict=True):
        own[s] += n
    names = sorted([s for s in own if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in own)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed = Fraction(3, 2) * sum(own.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if share[s] > 2 * own[s]]
        if not above:
            return own, fixed | share
        fixed |= {s: Fraction(2 * own[s]) for s in above}


def without_repeats(data, key=lambda r: r[0], window=100):
    seen, out = {}, {}
    for r in sorted(data, key=lambda r: (key(r) is not None, key(r) or 0)):
        b = (r[1] or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            w = b[i : i + window]
            if w in seen:
                gone[i : i + window] = [True] * window
            else:
                seen[w] = True
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[r[0]] = (len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_groups(data, k, num, den):
    sets = [shingles(t, k) for _, t, *_ in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(data))


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {i + j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(8)}
    lines, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in lines
            lines.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
