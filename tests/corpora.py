"""Test corpora, and the scoring formula stated without the library."""

import hashlib
import math
import re
from collections import Counter

CUSTOMER_SCHEMA = ("customer_id long, name string, email string, country string, "
                   "updated_at timestamp")
CASE_SCHEMA = ("case_id long, customer_id long, title string, description string, "
               "status string, updated_at timestamp")

INGEST_CASES = [
    (1, 1, "Crane brake worn", "harbour crane brake grinding", 1),
    (2, 1, "Storm signal lamp", "storm lamp flickers before gale warning", 2),
    (3, 2, "Pump seal leak", "pump seal leaking on the north quay", 3),
    (4, 2, "Tide gauge drift", "tide gauge reads high after calibration", 4),
    (5, 3, "Pilot boat fuel", "pilot boat fuel filter clogged", 5),
]

SEARCH_CASES = [
    (1, "Harbour crane brake", "crane brake pads replaced harbour office informed"),
    (2, "Storm lamp flicker", "storm lamp flickers gale warning late"),
    (3, "Quay pump repair", "pump seal leaking repair crew booked"),
    (4, "Tide gauge check", "tide gauge calibration drift measured"),
    (5, "Harbour pilot boat", "pilot boat fuel filter harbour depot"),
    (6, "Gale damage survey", "storm damage quay harbour wall crane lamp"),
    (7, "Harbour storm drill", "harbour storm drill lamp crane pump crew"),
    (8, "Repair crew roster", "repair crew roster crane pump harbour"),
]

DIMS = 16384


def _vector(text):
    """Term counts by dimension, stated without the library."""
    words = [w for w in re.split("[^a-z0-9]+", text.lower()) if len(w) > 1]
    return Counter(int(hashlib.sha256(w.encode()).hexdigest()[:8], 16) % DIMS for w in words)


def golden(rows, query, top_k):
    """(id, score) by the formula in plain Python: raw query counts, tf * idf documents."""
    docs = {i: _vector(f"{title} {text}") for i, title, text in rows}
    df = Counter(d for v in docs.values() for d in v)
    unit = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0
    q, out = _vector(query), []
    for i, v in docs.items():
        w = {d: n * math.log(1 + len(docs) / (1 + df[d])) for d, n in v.items()}
        s = round(sum(n * w.get(d, 0.0) for d, n in q.items()) / (unit(q) * unit(w)), 8)
        if any(d in w for d in q):
            out.append((i, s))
    return sorted(out, key=lambda r: (-r[1], r[0]))[:top_k]
