"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import base64
import collections
import re

import tiktoken

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"


def line_dedup(texts, min_docs=10, min_chars=1):
    """From {id: text} to {id: (kept text, lines, dropped)}."""
    key = lambda line: line.strip(SPACES).translate(UPPER)
    lines = {i: (t or "").split("\n") for i, t in texts.items()}
    counts = collections.Counter(k for ls in lines.values() for k in {key(x) for x in ls} if len(k) >= min_chars)
    kept = {i: [x for x in ls if counts[key(x)] < min_docs] for i, ls in lines.items()}
    return {i: ("\n".join(kept[i]), len(lines[i]), len(lines[i]) - len(kept[i])) for i in texts}


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the quality rules."""
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered.update(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def passes(text):
    """The current quality policy."""
    n, chars, symbols, dup, repeated = measures(text)
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    capitals = len(re.findall("[A-Z]", text or ""))
    bad = n < 10 or 100 * repeated > 20 * n or 10 * symbols > n or 2 * capitals > chars
    return not (bad or 2 * dup > len(lines) or 50 * len(set(words)) < n)


def shingles(text, size=5):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_components(texts, percent):
    """From {id: text} to {id: least id reachable over links}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


_EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens(text):
    return [w for w in (x.strip(_EDGE).translate(UPPER) for x in WORD.findall(text or "")) if w]


def holds_item(text, item, size=8):
    """Whether half of an item's plain windows occur in a text."""
    words, wanted = tokens(text), tokens(item)
    n = min(size, len(wanted))
    have = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    windows = [tuple(wanted[i : i + n]) for i in range(len(wanted) - n + 1)]
    return bool(wanted) and 2 * sum(w in have for w in windows) >= len(windows)


def byte_bpe():
    import public_tokenizers as public

    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def runs(words, min_words=6, min_times=4):
    """All (start, length, period), by trying every period everywhere."""
    found = {}
    for q in range(1, len(words) // min_times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(min_words, min_times * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cheapest_edits(turns, insertions=2):
    """Of all edits of (role initial, fault) turns the least (cost, letters), by trying them all."""
    best = None

    def go(i, inserted, cost, letters, roles):
        nonlocal best
        if not re.match(r"(s?(ua)*u?)\Z", roles) or best and cost > best[0]:
            return
        if i == len(turns) and re.match(r"(s?(ua)+)?\Z", roles):
            best = min(best or (cost, letters), (cost, letters))
        if inserted < insertions:
            for role in "ua":
                go(i, inserted + 1, cost + 5, letters + "I", roles + role)
        if i < len(turns):
            role, fault = turns[i]
            more = 5 if fault == 3 else 0
            go(i + 1, inserted, cost + 2, letters + "D", roles)
            if fault not in (1, 2):
                go(i + 1, inserted, cost + more, letters + "K", roles + role)
                for other in "ua":
                    go(i + 1, inserted, cost + 1 + more, letters + "R", roles + other)

    go(0, 0, 0, "", "")
    return best


def repaired(turns, letters):
    """The lines ``role:text`` that edits leave of (role, text) turns."""
    lines, roles, turns = [], "", iter(turns)
    for letter in letters:
        wanted = "assistant" if roles.endswith("u") else "user"
        role, text = (wanted, "") if letter == "I" else next(turns)
        if letter != "D":
            role = role if letter == "K" else wanted
            lines.append(f"{role}:{text}")
            roles += role[:1]
    return lines
