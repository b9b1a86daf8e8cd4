"""Plain single-machine versions of the queries, written from their contracts alone."""

import hashlib
import re
from collections import defaultdict
from itertools import combinations


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_sets(documents):
    out = {}
    for doc, text in documents:
        words = words_of(ascii_lower(text or ""))
        size = min(5, len(words))
        out[doc] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    return out


def components(documents):
    """op1: doc_id -> (set size, component), over all pairs."""
    sets = shingle_sets(documents)
    parent = {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= 80 * (len(x) + len(y) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


def luhn(digits):
    values = [int(d) for d in digits][::-1]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    """op3: base spans (kind, start, end) by kind, then start."""
    out = []
    for kind, pattern in PERSONAL.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(re.fullmatch("0*([01]?[0-9]{1,2}|2[0-4][0-9]|25[0-5])", part) for part in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def passages(documents, size=50):
    """op4: doc_id -> (n_words, n_removed, kept text)."""
    first = {}
    for doc, text in documents:
        words = words_of(text)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            first[window] = min(first.get(window, doc), doc)
    out = {}
    for doc, text in documents:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < doc:
                gone.update(range(i, i + size))
        out[doc] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def edited_texts(documents):
    """op5: doc_id -> the edited text."""
    ordered = sorted(documents, reverse=True)
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text) // 3
        out[doc] = text[: len(text) - n] + following[:n]
    return out


SECRETS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def secrets(text):
    """op7: base spans (kind, start, end) by start, then kind as listed."""
    out = []
    for rank, (kind, pattern) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text or ""):
            long_enough = {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20,
                           "hex": lambda: len(m[0]) >= 24}[kind]()
            if long_enough:
                out.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def contamination(documents, benchmark):
    """op9: doc_id -> (n_words, n_hit, item ids sorted)."""

    def plain(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))

    items = defaultdict(set)
    for item, text in benchmark:
        words = plain(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            items[tuple(words[i : i + size])].add(str(item))
    sizes = {len(window) for window in items}
    out = {}
    for doc, text in documents:
        words = plain(text)
        hit, owners = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                window = tuple(words[i : i + size])
                if window in items:
                    hit.update(range(i, i + size))
                    owners |= items[window]
        out[doc] = (len(words), len(hit), sorted(owners))
    return out


def chats(conversations):
    """op10: conv_id -> (n_turns, turns digest, loss chars, loss digest); rows (conv, turn, role, text)."""
    by_id = defaultdict(list)
    for conv, turn, role, text in conversations:
        by_id[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in by_id.items():
        turns.sort()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        joined = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        out[conv] = (len(turns), sha(joined), len(loss), sha(loss))
    return out


def source_audit(rows, min_docs, most=50):
    """op11: {(lang, source, part, item, value, rank)} for rows of (lang, source, text)."""
    groups, docs, langs = defaultdict(lambda: defaultdict(int)), defaultdict(lambda: defaultdict(int)), {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text or ""))
        groups[lang, source]
        for term in terms:
            groups[lang, source][term] += 1
        for term in set(terms):
            docs[lang][term] += 1
    out = set()
    for lang in {lang for lang, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for other, s in groups if other == lang]

        def shares(counts):
            total = sum(counts.get(t, 0) for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts.get(t, 0) + 5) // total for t in kept}

        whole = defaultdict(int)
        for s in sources:
            for t, n in groups[lang, s].items():
                whole[t] += n
        q, p = shares(whole), {s: shares(groups[lang, s]) for s in sources}
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if groups[lang, s].get(t) and p[s][t] > q[t]]
            for part, items, last in (("pair", pair, len(pair)), ("term", term, most)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items[:last], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def license_places(text):
    """op12: (number of words, [(start, label)] of all places of the phrases)."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    out = []
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return len(words), sorted(out)


def alignments(texts, a, a_bytes, b, b_bytes):
    """op13: per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), for the libraries a and b."""
    aligned = []
    for text in texts:
        ids = ([], [])
        if text:
            ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
        spelled = [[table[i] for i in own] for own, table in zip(ids, (a_bytes, b_bytes), strict=True)]
        if any(b"".join(own) != b" " + text.encode() for own in spelled if text):
            ids, spelled = ([], []), [[], []]
        ends = [[sum(map(len, own[: i + 1])) for i in range(len(own))] for own in spelled]
        groups, links, at = [], [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            own = []
            for side in (0, 1):
                start, at[side] = at[side], ends[side].index(end) + 1
                own.append(range(start, at[side]))
            spans = [{i: (ends[s][i] - len(spelled[s][i]), ends[s][i]) for i in own[s]} for s in (0, 1)]
            links += [
                (ids[0][i], ids[1][j]) for i, (s, e) in spans[0].items() for j, (t, f) in spans[1].items()
                if max(s, t) < min(e, f)
            ]
            groups.append("|".join(",".join(str(ids[s][i]) for i in own[s]) for s in (0, 1)))
        aligned.append((len(ids[0]), len(ids[1]), groups, links))
    held, best = defaultdict(int), defaultdict(int)
    for *_, links in aligned:
        for pair in set(links):
            held[pair] += 1
    for (first, _), n in held.items():
        best[first] = max(best[first], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(held[x] == best[x[0]] for x in links),
         sum(held[x] for x in links), ";".join(groups))
        for n_a, n_b, groups, links in aligned
    ]
