"""Plain Python versions of the operators, and rows that are hard on them."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, node int, _row int"

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return [WORDS[i] for i in rng.integers(0, len(WORDS), n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hard_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, shared passages, and
    extra columns named like those that operators add."""
    base, passage = prose(1, 120), prose(2, 80)
    near = base[:60] + ["changed"] + base[61:]
    texts = {
        0: " ".join(base),
        1: " ".join(base),
        2: " ".join(near),
        3: None,
        4: "",
        5: " \t\n ",
        6: " ".join(prose(3, 30) + passage + prose(4, 30)),
        7: "\n".join(passage),
        8: " ".join(prose(5, 45) + passage[:55]),
        9: " ".join(prose(6, 49)),
        10: " ".join(prose(6, 49)),
        11: " ".join(prose(7, 20_000)),
        12: "12345 ... 678 !!!",
        13: "Ünïcode wörds " * 40,
        14: "one",
        15: "ONE",
        16: "x" * 200_000 + " " + "y" * 100_000,
        17: " ".join(["again"] * 300),
    }
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or ""), 0.5, "k", i, -i) for i, t in texts.items()]
    rows += [rows[0], rows[0], rows[14]]  # repeated rows
    rows += [(None, " ".join(base), None, None, None, None, None, None, None)]
    rows += [(None, None, None, None, None, None, None, None, None)]
    rows += [(20, " ".join(passage), "en", None, 5, 0.5, "k", 1, 1), (20, " ".join(passage + ["more"]), "en", "", 5, 0.5, "k", 1, 1)]
    return rows


# --- decontamination ---------------------------------------------------------------

_ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(text):
    return _ITEM_WORD.findall((text or "").translate(_LOW))


def contamination(text, items):
    """``n_words, n_hit, n_items, items_sha256, contaminated``."""
    words, hit, found = item_words(text), set(), set()
    places = defaultdict(list)
    for i, w in enumerate(words):
        places[w].append(i)
    for item, passage in items:
        needles = item_words(passage)
        for k in range(max(1, len(needles) - 9) if needles else 0):
            needle = needles[k : k + 10]
            for i in places.get(needle[0], ()):
                if words[i : i + len(needle)] == needle:
                    hit.update(range(i, i + len(needle)))
                    found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


# --- exact and substring dedup -----------------------------------------------------


def kept_copies(rows):
    """Sorted ``doc_id, keep_id, group_size, text_sha256`` with how many of the rows stay."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out[i, max(known) if known else None, len(ids), sha(text)] += 1
    return out


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_repeats(rows, window=50):
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    first = {}
    for doc_id, text, *_ in rows:
        words = spaced_words(text)
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        words = spaced_words(text)
        cut = bytearray(len(words))
        for i in range(len(words) - window + 1 if doc_id is not None else 0):
            if first[tuple(words[i : i + window])] < doc_id:
                cut[i : i + window] = b"\1" * window
        out.append((doc_id, len(words), sum(cut), sha(" ".join(w for w, c in zip(words, cut) if not c))))
    return out


# --- near dedup --------------------------------------------------------------------


def shingle_weights(texts):
    """Weights of each text's shingles, without hashing of frequencies into features."""
    sets = []
    for text in texts:
        words = item_words(text)
        grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        sets.append(Counter(grams))
    seen = Counter(g for s in sets for g in s)
    n = sum(1 for s in sets if s)
    idf = {g: 1 + 0.25 * np.log((1 + n) / (1 + c)) / np.log(2 + n) for g, c in seen.items()}
    return [{g: (1 + np.log(c)) * idf[g] for g, c in s.items()} for s in sets]


def weighted_jaccard(a, b):
    least = sum(min(a[g], b[g]) for g in a.keys() & b.keys())
    return least / (sum(a.values()) + sum(b.values()) - least) if a and b else 0.0


def near_pairs(texts, least):
    """Index pairs of similar texts, by an index of shingles."""
    weights = shingle_weights(texts)
    holders = defaultdict(list)
    for i, w in enumerate(weights):
        for g in w:
            holders[g].append(i)
    pairs = {(a, b) for ids in holders.values() for n, a in enumerate(ids) for b in ids[n + 1 :]}
    return {(a, b): s for a, b in pairs if (s := weighted_jaccard(weights[a], weights[b])) >= least}


def groups_of(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- secrets -----------------------------------------------------------------------

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(text):
    """``n_assign, n_access, n_hex, base_sha256``."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    found.sort()
    counts = [sum(f[1] == k for f in found) for k in range(3)]
    return (*counts, sha(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)))
