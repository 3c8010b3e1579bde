"""Plain, slow versions of the operators that SQL can't express."""

import hashlib
import itertools
import re
import unicodedata
import zlib

import zstandard

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def jaccard_components(docs, percent=85, width=4):
    """{row number: (doc_id, set size, component)} of (doc_id, text) rows."""
    sets = [shingles(text, width) for _, text in docs]
    label = list(range(len(docs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    index = {}
    for i, found in enumerate(sets):
        for shingle in found:
            index.setdefault(shingle, []).append(i)
    overlap = {}
    for rows in index.values():
        for pair in itertools.combinations(rows, 2):
            overlap[pair] = overlap.get(pair, 0) + 1
    for (i, j), common in overlap.items():
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            label[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            best[find(i)] = min(doc_id, best.get(find(i), doc_id))
    return sorted(
        ((doc_id, len(sets[i]), best.get(find(i))) for i, (doc_id, _) in enumerate(docs)), key=str
    )


def repeats(docs, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows, in order."""
    seen, rows = set(), []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - length + 1):
            window = data[start : start + length]
            if window in seen:
                gone[start : start + length] = b"\x01" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        rows.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def license_places(text, phrases):
    """(words, number of places, first, last, labels) of the phrases in a text."""
    words = alnum_words(text)
    found = []
    for phrase, label in phrases.items():
        wanted = phrase.split()
        found += [
            (i, label) for i in range(len(words) - len(wanted) + 1)
            if words[i : i + len(wanted)] == wanted
        ]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({label for _, label in found}))
    return (
        len(words), len(found), min(starts, default=None), max(starts, default=None), labels,
    )


def leaks(text, items, width=10):
    """(words, hit words, item ids) of a text against (item_id, text) pairs."""
    words = alnum_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = alnum_words(item)
        length = min(width, len(own))
        windows = {tuple(own[i : i + length]) for i in range(len(own) - length + 1)} if own else ()
        for i in range(len(words) - length + 1 if windows else 0):
            if tuple(words[i : i + length]) in windows:
                hit.update(range(i, i + length))
                found.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in found if i is not None)


def exact_classes(docs):
    """(doc_id, keep_id, group size) of (doc_id, text) rows."""
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(normalised(text), []).append(doc_id)
    rows = []
    for doc_id, text in docs:
        own = groups[normalised(text)]
        rows.append((doc_id, min((i for i in own if i is not None), default=None), len(own)))
    return sorted(rows, key=str)


def mix(docs, weights=(3, 1, 2), share=1.5):
    """{(doc_id, source): taken} of (doc_id, text, source) rows with different ids."""
    sizes, rows = {}, []
    for doc_id, text, source in docs:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()
        rows.append((source, int(digest[:15], 16), size, doc_id))
        sizes[source] = sizes.get(source, 0) + size
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    goal, full = dict.fromkeys(names, 0.0), set()
    rest = share * sum(sizes.values())
    while rest > 1e-9 and len(full) < len(names):  # hand the rest out again and again
        unit = rest / sum(weight[n] for n in names if n not in full)
        rest = 0.0
        for name in [n for n in names if n not in full]:
            goal[name] += unit * weight[name]
            if goal[name] >= 2 * sizes[name]:
                rest += goal[name] - 2 * sizes[name]
                goal[name] = 2.0 * sizes[name]
                full.add(name)
    taken = {}
    for name in names:
        whole = round(goal[name], 6) >= sizes[name]
        budget = round(goal[name]) - whole * sizes[name]
        upto, open_ = 0, True
        for _, _, size, doc_id in sorted(r for r in rows if r[0] == name):
            below = open_ and (upto + size <= budget or 2 * (budget - upto) > size)
            if open_ and upto + size > budget:
                open_ = False
            upto += size
            taken[doc_id, name] = size * (whole + below)
    return taken, goal


def damaged(rows):
    """(conv_id, turn, role, text) rows with the planted faults of the conversation query."""
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        role = "user" if fate == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def repairs(rows, convs):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)}."""
    done = {}
    for conv in convs:
        own = sorted(
            (r for r in rows if r[0] == conv),
            key=lambda r: (
                r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest(),
            ),
        )
        faults, seen = [], set()
        for _, _, role, text in own:
            visible = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = (
                "blank" if not visible else "duplicate" if (role, text) in seen
                else "truncated" if visible[-1] not in ".!?" else None
            )
            faults.append(fault)
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        due = {"": "u", "s": "u", "u": "a", "a": "u"}  # by the role before
        best = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
        table = [best]
        for i in reversed(range(len(own))):
            direct = {}
            for state in due:
                options = [(4 + best[state][0], "D" + best[state][1])]
                if faults[i] not in ("blank", "duplicate"):
                    extra = 3 * (faults[i] == "truncated")
                    if initials[i] == due[state] or (initials[i], state) == ("s", ""):
                        cost, rest = best[initials[i]]
                        options.append((extra + cost, "K" + rest))
                    cost, rest = best[due[state]]
                    options.append((3 + extra + cost, "R" + rest))
                direct[state] = min(options)
            for _ in range(3):
                direct = {
                    s: min(direct[s], (3 + direct[due[s]][0], "I" + direct[due[s]][1])) for s in due
                }
            best = direct
            table.append(best)
        cost, audit = best[""]
        state, at, lines = "", 0, []
        for letter in audit:
            if letter == "I":
                state = due[state]
                lines.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, _, role, text = own[at]
            at += 1
            if letter == "K":
                state = role[:1]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = due[state]
                lines.append({"u": "user:", "a": "assistant:"}[state] + text)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(kind) for kind in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        done[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return done


def phrase_counts(docs, longest=4):
    """({(lang, phrase): count}, {lang: words}) of (lang, text) rows; phrases are tuples."""
    counts, totals = {}, {}
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(words)
            for width in range(1, longest + 1):
                for i in range(len(words) - width + 1):
                    key = lang, tuple(words[i : i + width])
                    counts[key] = counts.get(key, 0) + 1
    return counts, totals


def collocations(docs, least=30, best=2000):
    """Sorted (lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, totals = phrase_counts(docs)
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    rows = []
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * f >= 80 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), f in candidates.items()
        )
        if inside:
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
        score, k, l, r = min((2000000 * a // (l + r), k, l, r) for l, r, k in cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), l, r))
    out, rank = [], {}
    for lang, score, a, phrase, l, r in sorted(rows):
        rank[lang] = rank.get(lang, 0) + 1
        if rank[lang] <= best:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return out


QUALITY_COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def quality_counts(text):
    """The base counts of the quality rules."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w in windows if windows.count(w) > 1} if len(words) < 3000 else None
    if often is None:
        seen = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        often = {w for w, n in seen.items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def smallest_language(text, dictionaries, chunk=1024, level=6):
    """(language, saving over the runner-up) by compressing chunk after chunk."""
    if not any(unicodedata.category(c).startswith("L") for c in text or ""):
        return "und", 0.0
    data = text.translate(LOWER).encode()
    sizes = []
    for place, (name, content) in enumerate(dictionaries.items()):
        total = 0
        for i in range(0, len(data), chunk):
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=level)
            packer = zstandard.ZstdCompressor(
                level=level, dict_data=own, write_content_size=False, write_dict_id=False)
            total += len(packer.compress(data[i : i + chunk]))
        sizes.append((total, place, name))
    first, second = sorted(sizes)[:2]
    return first[2], 1 - first[0] / second[0]


def secret_spans(text):
    """(start, end, kind) of the three fixed patterns, each searched from its first character."""
    found = []
    value = "[A-Za-z0-9+/_.=-]+"
    names = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]" \
        "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    pattern = re.compile(f"""{names}["']?\\x20*[:=]\\x20*["']?({value})""")
    for kind, own, least, group in (
        (0, pattern, 6, 1), (1, re.compile("AKIA[A-Z0-9]+"), 20, 0), (2, re.compile("[0-9a-f]+"), 24, 0),
    ):
        at = 0
        while match := own.search(text, at):
            if len(match[group]) >= least:
                found.append((match.start(), match.end(), kind))
            at = match.end()
    return sorted(found, key=lambda span: (span[0], span[2]))


def toxicity(folded, weights, exceptions):
    """Summed weights of the words of a folded text, term by term and place by place."""
    hits = {}
    covered = set()

    def places(term):
        at = folded.find(term)
        while at >= 0:
            if not at or not folded[at - 1].isalpha():
                yield at, at + len(term)
            at = folded.find(term, at + 1)

    def whole(end):
        return end == len(folded) or not folded[end].isalpha()

    for phrase in exceptions:
        for start, end in places(phrase):
            if whole(end):
                covered |= set(range(start, end))
    for term, weight in weights.items():
        for start, end in places(term.rstrip("*")):
            if term.endswith("*") or whole(end):
                hits[start] = max(hits.get(start, 0.0), weight)
    return sum(weight for start, weight in hits.items() if start not in covered)
