"""Plain Python versions of operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_components(docs, pct=85):
    """doc_id -> smallest doc_id reachable over links of all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in sets}


SENTENCE = re.compile(r"(?<=[.!?])[\"')\]]*[ \t\r\x0b\x0c]+|[ \t\r\x0b\x0c]*\n\s*")


def sentences(text):
    """(start, end, words) of every sentence; the end is where the next one starts."""
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out, first = [], 0
    for k, (s, e) in enumerate(words):
        word = text[s:e]
        stop = word[-1] in ".!?" or (word[-1] in "\"')]" and len(word) > 1 and word[-2] in ".!?")
        if k + 1 < len(words):  # a capital after a word in lower case, by first characters up to U+00FF
            after = text[words[k + 1][0]]
            stop = stop or ((("a" <= word[0] <= "z") or "\xdf" <= word[0] <= "\xff") and (("A" <= after <= "Z") or "\xc0" <= after <= "\xde"))
        if k + 1 == len(words) or stop or "\n" in text[e : words[k + 1][0]]:
            end = len(text) if k + 1 == len(words) else words[k + 1][0]
            out.append((words[first][0], end, tuple(text[a:b].translate(LOWER) for a, b in words[first : k + 1])))
            first = k + 1
    return out


def passage_runs(sents, least=2, words=25, long=15):
    runs = set()
    for i in range(len(sents)):
        if len(sents[i][2]) >= long:
            runs.add((i, i))
        n = 0
        for j in range(i, len(sents)):
            n += len(sents[j][2])
            if n >= words and j - i + 1 >= least:
                runs.add((i, j))
                break
        n = 0
        for j in range(i, -1, -1):
            n += len(sents[j][2])
            if n >= words and i - j + 1 >= least:
                runs.add((j, i))
                break
    return runs


def without_passages(docs):
    """doc_id -> text; docs: (doc_id, text) with distinct ids."""
    first, cut, parsed = {}, {}, {}
    for i, text in sorted(docs):
        sents = parsed[i] = sentences(text or "")
        for a, b in sorted(passage_runs(sents)):
            key = tuple(w for s in sents[a : b + 1] for w in s[2])
            if first.setdefault(key, (i, a)) != (i, a):
                cut.setdefault(i, set()).update(range(a, b + 1))
    out = {}
    for i, text in docs:
        if i not in cut:
            out[i] = text
            continue
        sents = parsed[i]
        keep = [text[s:e] for k, (s, e, _) in enumerate(sents) if k not in cut[i]]
        out[i] = (text[: sents[0][0]] + "".join(keep)).rstrip(" \t\n\r\x0b\x0c")
    return out
