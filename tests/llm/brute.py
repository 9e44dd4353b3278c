"""Plain versions of what the operators compute."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

from millrace.llm.prefix_bpe import Ranks

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def ranks():
    return Ranks.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def tiktoken_encoding(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def ids_rows(docs, end_id=2):
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = set(), 0
    for doc_id, text in sorted(docs):
        ids = np.array([*made.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        out.add((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def bpe_rows(docs):
    own = tiktoken_encoding(ranks())
    out = []
    for doc_id, text in docs:
        ids = own.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def fingerprint(text, width=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def shingle_set(text, width=5):
    words = re.sub("[A-Z]", lambda m: m.group().lower(), text or "").encode().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def near_rows(docs, least=0.8):
    """(id, component) by the similarity of the sets of five-word shingles."""
    sets = [shingle_set(t) for _, t in docs]
    return [(d, c) for (d, _), c in zip(docs, components([d for d, _ in docs], lambda i, j: jaccard(sets[i], sets[j]) >= least))]


def simhash_rows(docs, bits=3):
    prints = [(d, fingerprint(t)) for d, t in docs]
    found = components([d for d, _ in docs], lambda i, j: (prints[i][1] ^ prints[j][1]).bit_count() <= bits)
    return [(d, f"{f:016x}", c) for (d, f), c in zip(prints, found)]


def components(ids, linked):
    """The least id (None is no name) of each row's component."""
    label = list(range(len(ids)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    def digits(x):
        return re.sub("[^0-9]", "", x)

    found = []
    for kind, (name, pattern, good) in enumerate(
        [
            ("email", EMAIL, lambda x: True),
            ("ip", IP, lambda x: all(int(p) <= 255 for p in x.split("."))),
            ("card", CARD, lambda x: 14 <= len(digits(x)) <= 19 and luhn(digits(x))),
            ("phone", PHONE, lambda x: 10 <= len(digits(x)) <= 15),
        ]
    ):
        found += [(m.start(), kind, f"{name}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if good(m.group())]
    return [x[2] for x in sorted(found)]


def unigram_count(data, scores):
    best = [(0.0, 0)]
    for end in range(1, len(data) + 1):
        best.append(max((best[s][0] + scores[data[s:end]], best[s][1] - 1) for s in range(end) if data[s:end] in scores))
    return -best[-1][1]
