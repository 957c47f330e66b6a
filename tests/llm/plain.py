"""Plain versions of operators for small inputs."""

import hashlib
import re

BLANKS = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(BLANKS, text or "")


def shingles(text, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return set(zip(*[w[i:] for i in range(k)])) if len(w) >= k else {tuple(w)}


def classes(rows, k, num, den=100):
    """(doc_id, set size, least id of the class) for rows (doc_id, text)."""
    return [r[:3] for r in numbered_classes(rows, k, num, den)]


def numbered_classes(rows, k, num, den=100):
    """The same with a number that names the class."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and den * common >= num * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d, find(i)) for i, (d, _) in enumerate(rows)]


def removed_passages(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for rows (doc_id, text)."""
    known = [(1 << 63 if d is None else d, (t or "").encode(), d) for d, t in rows]
    first = {}
    for key, body, _ in known:
        for i in range(len(body) - length + 1):
            s = body[i:i + length]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, body, doc_id in known:
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if first[body[i:i + length]] < key:
                gone[i:i + length] = b"\1" * length
        spans = sum(bool(gone[i]) and not (i and gone[i - 1]) for i in range(len(gone)))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((doc_id, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def without_boilerplate(rows, min_sites):
    """Texts of rows (doc_id, text, site) without lines on min_sites sites, but for their first occurrence."""
    sites, first = {}, {}
    for doc_id, text, site in rows:
        for i, line in enumerate((text or "").split("\n")):
            key = line.strip(" \t\n\v\f\r")
            if key and text is not None:
                sites.setdefault(key, set()).add(site)
                at = (doc_id is None, doc_id or 0, i)
                first[key] = min(first.get(key, at), at)
    out = []
    for doc_id, text, _ in rows:
        if text is None:
            out.append(None)
            continue
        kept = [line for i, line in enumerate(text.split("\n"))
                if len(sites.get(key := line.strip(" \t\n\v\f\r"), ())) < min_sites or first[key] == (doc_id is None, doc_id or 0, i)]
        out.append("\n".join(kept))
    return out
