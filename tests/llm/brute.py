"""Plain versions of the contracts, row by row, for small tables."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import regex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def lower(s):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), s)


def secrets(text):
    text = text or ""
    own = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    own += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    own += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    n = Counter(k for _, k, _ in own)
    said = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(own))
    return n[0], n[1], n[2], hashlib.sha256(said.encode()).hexdigest(), said


def quality(text):
    words = WORD.findall(text or "")
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    again = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again), n < 50 or 100 * len(again) > 50 * n


BOILERPLATE = ["all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "enable javascript", "click here", "read more", "sign in", "sign up", "log in", "subscribe to", "share this", "skip to content", "licensed under"]


def line_stays(line):
    low, shown = line.lower(), line.rstrip(" \t\n\x0b\x0c\r")
    if shown[-1] not in ".!?…:;,\"'”’»)]" or len(re.findall(r"[|»›•>]", line)) >= 2 or len(re.findall(r"[#*$%&|<>]", line)) * 12 > len(line):
        return False
    if len(line) > 20 and any(c.isupper() for c in line) and not any(c.islower() for c in line):
        return False
    held = re.findall("|".join(BOILERPLATE), low)
    return not held or 8 * sum(map(len, held)) < len(low)


def kept(text):
    """The verdict of the line-first rules, and the text that they leave."""
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    good = [x for x in lines if line_stays(x)]
    return not quality(text)[-1] and 2 * (sum(map(len, lines)) - sum(map(len, good))) <= sum(map(len, lines)), "\n".join(good)


def line_dedup(rows, least=5):
    """rows of (doc_id, text) to {row number: (n_lines, n_dropped, sha256)}."""
    held = defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(held[key(x)]) < least or max(held[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def line_texts(rows, least=5):
    """The texts of rows of (doc_id, text) without the lines that `line_dedup` drops."""
    held = defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for doc, text in rows:
        for line in text.split("\n"):
            held[key(line)].add(doc)
    stays = lambda doc, k: len(k) < 40 or len(held[k]) < least or max(held[k]) == doc
    return ["\n".join(x for x in text.split("\n") if stays(doc, key(x))) for doc, text in rows]


def pieces(text, limit=4096):
    """(piece, start, length, crc32) of a text's ids by the tokenizer itself."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    if not hasattr(pieces, "tokenizer"):
        pieces.tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    ids = pieces.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    cut = [ids[a : a + limit] for a in range(0, len(ids), limit)]
    return [(k, limit * k, len(c), zlib.crc32(struct.pack(f"<{len(c)}I", *c))) for k, c in enumerate(cut)]


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(rows, num=85, den=100):
    """rows of (doc_id, text) to {doc_id: (n_shingles, component_id)} by all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    up = {d: d for d in sets}

    def root(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    shared = Counter()
    for v in by.values():
        for i, a in enumerate(v):
            for b in v[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def suffix_dedup(rows, length=400):
    """rows of (doc_id, text) to (doc_id, n_bytes, n_removed, n_spans, sha256) by all strings of `length` bytes."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def letters_of(text):
    """Lower-cased letters, a space after each run."""
    return "".join(w + " " for w in re.findall(r"[^\W\d_]+", text.lower()))


class KneserNey:
    """Interpolated Kneser-Ney over characters in dictionaries, five-grams down to single ones."""

    def __init__(self, texts):
        self.count = {5: Counter()}
        for t in texts:
            t = "    " + letters_of(t)
            self.count[5].update(t[i : i + 5] for i in range(len(t) - 4) if len(t) > 4)
        for n in range(4, 0, -1):
            self.count[n] = Counter(g[1:] for g in self.count[n + 1])
        self.letters = set(self.count[1])
        self.cut, self.total, self.kinds = {}, defaultdict(Counter), defaultdict(Counter)
        for n, count in self.count.items():
            spread = Counter(count.values())
            self.cut[n] = min(0.9, max(0.1, spread[1] / max(1, spread[1] + 2 * spread[2])))
            for g, c in count.items():
                self.total[n][g[:-1]] += c
                self.kinds[n][g[:-1]] += 1

    def p(self, gram, letters):
        n = len(gram)
        if not n:
            return 1 / (letters + 1)
        low, total = self.p(gram[1:], letters), self.total[n][gram[:-1]]
        if not total:
            return low
        return max(self.count[n][gram] - self.cut[n], 0) / total + self.cut[n] * self.kinds[n][gram[:-1]] / total * low

    def nats(self, text, letters):
        t = "    " + letters_of(text)
        known = {}
        return -sum(math.log(known[g] if g in known else known.setdefault(g, self.p(g, letters))) for g in (t[i : i + 5] for i in range(len(t) - 4)))


def template(text, units, number, unit, name):
    """(template words, words with values) of a text, by the same marks."""
    t = regex.sub(r"(?<=[\p{Ll},;] )(\p{Lu}\p{L}*)", lambda m: name + m[1], text)
    if regex.search(r"\p{Nd}", text):
        t = regex.sub(r"(?<![\p{L}\p{N}])(\p{Nd}+(?:[.,:]\p{Nd}+)*)", lambda m: number + m[1], t)
        t = regex.sub(rf"({number}[\p{{Nd}}.,:]+)\s*((?i:{'|'.join(units)}))(?!\p{{L}})", lambda m: f"{m[1]} {unit}{m[2]}", t)
    marks = f"{number}-{name}"
    words = lambda x: [w for w in regex.split(rf"(?:[^\p{{L}}\p{{N}}{marks}.,:]|[.,:](?!\p{{N}}))+", x) if w]
    return words(regex.sub(rf"([{marks}])[\p{{L}}\p{{N}}]+(?:[.,:]\p{{N}}+)*", lambda m: m[1], t).lower()), words(t)


def decontamination(docs, items, units, marks, width=8, share=0.5, consistency=0.7, gap=3):
    """{(doc_id, class_id): (matched, total, agreement, verbatim)} by comparing the windows themselves, one document and item at a time.

    Every item is compared; of those of a class the least is told, as they have the same windows and relations.
    """
    slot = lambda w: w[0] in marks

    def windows(text, w):
        words, raw = template(text, units, *marks)
        need = min(4, max(w - 1, 3))
        for at in range(len(words) - w + 1):
            own, values = words[at : at + w], raw[at : at + w]
            plain = sum(not slot(x) for x in own)
            yield at, (True, tuple(own)) if plain >= need else (False, tuple(v.lower() for v in values)), plain, [v for v in values if slot(v)]

    found, classes, copies = {}, {}, defaultdict(list)
    for item_id, item in sorted(items):
        w = min(width, len(template(item or "", units, *marks)[0]))
        theirs = [x for x in windows(item, w) if x[1][0] or w == width or x[2] >= 3] if w else []
        if not theirs:
            continue
        words, raw = template(item, units, *marks)
        values = [v for v in raw if slot(v)]
        shape = (tuple(words), tuple(values.index(v) for v in values), frozenset(key for _, key, _, _ in theirs if not key[0]))
        class_id = classes.setdefault(shape, item_id)
        kinds = {key for _, key, _, _ in theirs}
        total, total_all = sum(k[0] for k in kinds), len(kinds)
        places, places_all = sum(key[0] for _, key, _, _ in theirs), len(theirs)
        enough = lambda told, n, every, n_all: (n > 0 and told >= share * n) or every >= share * n_all
        for doc_id, text in docs:
            ours = defaultdict(list)
            for pos, key, _, slots in windows(text or "", w):
                ours[key].append((pos, slots))
            met = [(at, pos, key[0], mine, own) for at, key, _, mine in theirs for pos, own in ours.get(key, ())]
            held = {key for _, key, _, _ in theirs if key in ours}
            told, every = sum(k[0] for k in held), len(held)
            if not met or not enough(told, total, every, total_all):
                continue
            covered = {(at + i, x.lower()) for at, *_ in theirs for i, x in enumerate(raw[at : at + w]) if slot(x)}
            ours_raw = template(text, units, *marks)[1]
            for d in {m[1] - m[0] for m in met}:
                if covered and covered == {(m[0] + i, x.lower()) for m in met if m[1] - m[0] == d for i, x in enumerate(ours_raw[m[1] : m[1] + w]) if slot(x)}:
                    copies[doc_id, class_id].append(item_id)
                    break
            met.sort(key=lambda m: m[1] - m[0])
            groups, chain, before = defaultdict(list), 0, None
            for m in met:
                d = m[1] - m[0]
                chain += before is not None and d - before > min(gap, w - 1)
                before = d
                groups["at", d].append(m)
                groups["chain", chain].append(m)
            best = []
            for ms in [*(ms for ms in groups.values() if enough(len({m[0] for m in ms if m[2]}), places, len({m[0] for m in ms}), places_all)), met]:
                pairs = Counter((a, b) for m in ms for a, b in zip(m[3], m[4]))
                forth, back = Counter(), Counter()
                for (a, b), n in pairs.items():
                    forth[a], back[b] = max(forth[a], n), max(back[b], n)
                n = max(1, sum(pairs.values()))
                there, again = sum(forth.values()) / n, sum(back.values()) / n
                best.append(min(there, (there + again) / 2) if pairs else 1.0)
            if max(best) >= consistency and item_id == class_id:
                found[doc_id, item_id] = (told, total, max(best)) if total and told >= share * total else (every, total_all, max(best))
    return {k: (*v, copies[k]) for k, v in found.items()}
