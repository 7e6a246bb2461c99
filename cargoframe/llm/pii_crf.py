"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone). The random field
looks for further mentions of the same data: number runs and handles that the
patterns don't match. Its nodes are a text's base spans (their labels are
given), number runs of at least ``MIN_DIGITS`` digits, and words equal to the
name part of an email of the text. All other words are fixed to "no entity",
which cuts the chain there, so the field runs over the nodes alone.

* neighbouring nodes share a chain potential,
* nodes that repeat one another anywhere in the document (the same name part,
  or the same last digits) share a skip potential; each is linked to the next
  such node, so links grow with the nodes,
* loopy message passing sweeps the nodes forwards and backwards, and a node
  whose label has a probability of at least ``sure`` becomes a span unless it
  overlaps a base span.

Weights are trained by pseudo-likelihood on about ``sample_docs`` documents,
taken by a hash of their id, with the patterns' labels; nodes that repeat an
entity without being one are left open there. Only node features of that
sample reach the driver. Every whole text is labelled.

Defined cases: NULL and empty text have no spans; texts of any length take
linear time in the patterns; without training nodes nothing is added; repeated
rows are labelled each; NULL ids stay NULL and are not sampled; other columns
are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoframe.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone")
MIN_DIGITS, KEY_DIGITS, MIN_NAME = 7, 7, 4
N_LABELS, N_FEATURES = len(KINDS) + 1, 18
NEAR = 200  # code points between neighbours that share a chain potential

# fixed values: the base patterns
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_NUMBER = re.compile(r"\+?[0-9](?:[ ().-]{0,2}[0-9])+")
_HANDLE = re.compile(r"[A-Za-z0-9._%+-]+")


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def find_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern, in linear time: an ``@`` is
    matched by its domain, and its name part starts as far left as it can."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            low = m.end()
            out.append((start, low))
            at = text.find("@", low)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, in the order of ``KINDS``."""
    if not _ANY.search(text):
        return [[], [], [], []]
    ips = [m.span() for m in _IP.finditer(text)
           if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    cards = [m.span() for m in _CARD.finditer(text) if 13 <= len(d := digits_of(m.group())) <= 19 and luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15] if "+" in text else []
    return [find_emails(text) if "@" in text else [], ips, cards, phones]


def features(s: str) -> list[int]:
    """Binary features of a mention, as numbers below ``N_FEATURES``."""
    d = len(digits_of(s))
    on = [True, s[:1] == "+", "@" in s, s.count(".") == 3, "." in s, " " in s, "-" in s, "(" in s, d == 0, 7 <= d <= 8, 9 <= d <= 12,
          13 <= d <= 15, d == 16, d >= 17, d >= 13 and luhn(digits_of(s)), s.isdigit(), any(c.isalpha() for c in s), d == len(s)]
    return [k for k, x in enumerate(on) if x]


def graph(text: str, base: list[list[tuple[int, int]]]) -> tuple[list, list]:
    """Nodes (start, end, label or None, key) in reading order and edges
    (node, later node, 0 chain or 1 skip)."""
    taken = sorted((s, e, k + 1) for k, spans in enumerate(base) for s, e in spans)
    names = {text[s:text.index("@", s)].lower() for s, e in base[0]}
    names = {n for n in names if len(n) >= MIN_NAME}
    more = [m.span() for m in _NUMBER.finditer(text) if len(digits_of(m.group())) >= MIN_DIGITS]
    if names:
        more += [m.span() for m in _HANDLE.finditer(text) if m.group().lower() in names]
    nodes, at, high = [(s, e, k) for s, e, k in taken], 0, 0
    for s, e in sorted(set(more)):
        while at < len(taken) and taken[at][0] < e:
            high = max(high, taken[at][1])
            at += 1
        if high <= s:
            nodes.append((s, e, None))
    nodes.sort(key=lambda n: (n[0], n[1], n[2] or 0))
    out, last, edges = [], {}, []
    for i, (s, e, label) in enumerate(nodes):
        piece = text[s:e].lower()
        d = digits_of(piece)
        if label == 1 or piece in names:
            key = ("name", piece.split("@")[0])
        else:
            key = ("digits", d[-KEY_DIGITS:]) if label != 2 else ("ip", piece)
        out.append((s, e, label, key))
        if i and s - nodes[i - 1][1] <= NEAR:
            edges.append((i - 1, i, 0))
        if key in last:
            edges.append((last[key], i, 1))
        last[key] = i
    return out, edges


def marginals(unary: np.ndarray, edges: list, pots: np.ndarray, sweeps: int = 3) -> np.ndarray:
    """Label probabilities by loopy message passing, sweeping the nodes
    forwards and backwards. ``pots`` [type, label of first, label of second]."""
    n = len(unary)
    near: list[list] = [[] for _ in range(n)]
    for k, (a, b, kind) in enumerate(edges):
        near[a].append((2 * k, 2 * k + 1, b, pots[kind]))
        near[b].append((2 * k + 1, 2 * k, a, pots[kind].T))
    msg = np.zeros((2 * len(edges), unary.shape[1]))  # msg[x]: into the node that lists x second
    total = unary.copy()
    for sweep in range(2 * sweeps):
        for i in range(n) if sweep % 2 == 0 else range(n - 1, -1, -1):
            for out, back, j, pot in near[i]:
                z = pot + (total[i] - msg[back])[:, None]
                top = z.max(0)
                new = top + np.log(np.exp(z - top).sum(0))
                new -= new.max()
                total[j] += new - msg[out]
                msg[out] = new
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(docs: list, steps: int = 300, l2: float = 1e-3) -> dict:
    """Weights by pseudo-likelihood. ``docs``: (labels, features, edges) each;
    label -1 is open. Every node is conditioned on its neighbours' labels."""
    label, feats, left, right, kind = [], [], [], [], []
    for ys, fs, es in docs:
        at = len(label)
        label += ys
        feats += fs
        for a, b, k in es:
            if ys[a] >= 0 and ys[b] >= 0:
                left.append(at + a)
                right.append(at + b)
                kind.append(k)
    unary, pots = np.zeros((N_FEATURES, N_LABELS)), np.zeros((2, N_LABELS, N_LABELS))
    y = np.array(label, np.int64)
    use = np.flatnonzero(y >= 0)
    if not len(use):
        return {"unary": unary, "pots": pots, "trained": False}
    x = np.zeros((len(y), N_FEATURES))
    for i, f in enumerate(feats):
        x[i, f] = 1
    a, b, k = (np.array(v, np.int64) for v in (left, right, kind))
    hot = np.eye(N_LABELS)[np.clip(y, 0, None)]
    state = [np.zeros_like(unary), np.zeros_like(unary), np.zeros_like(pots), np.zeros_like(pots)]
    for t in range(1, steps + 1):
        z = x @ unary
        np.add.at(z, b, pots[k, y[a], :])
        np.add.at(z, a, pots[k, :, y[b]])
        p = np.exp(z - z.max(1, keepdims=True))
        err = np.where((y >= 0)[:, None], hot - p / p.sum(1, keepdims=True), 0) / len(use)
        gu, gp = x.T @ err - l2 * unary, -l2 * pots
        np.add.at(gp, (k, y[a]), err[b])
        np.add.at(gp.transpose(0, 2, 1), (k, y[b]), err[a])
        for w, g, m, v in ((unary, gu, *state[:2]), (pots, gp, *state[2:])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            w += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {"unary": unary, "pots": pots, "trained": True}


def training_rows(text: str) -> tuple[list, list, list] | None:
    base = base_spans(text)
    nodes, edges = graph(text, base)
    if not nodes:
        return None
    entity = {n[3] for n in nodes if n[2] is not None}
    labels = [n[2] if n[2] is not None else -1 if n[3] in entity else 0 for n in nodes]
    return labels, [features(text[n[0]:n[1]]) for n in nodes], edges


def added_spans(text: str, base: list, model: dict, sure: float = 0.6) -> list[list[tuple[int, int]]]:
    """Spans of each kind that the field adds to the base spans."""
    out: list[list] = [[], [], [], []]
    if not model["trained"] or not _ANY.search(text):
        return out
    nodes, edges = graph(text, base)
    if all(n[2] is not None for n in nodes):
        return out
    unary = np.stack([np.where(np.arange(N_LABELS) == n[2], 0, -50.0) if n[2] is not None
                      else model["unary"][features(text[n[0]:n[1]])].sum(0) for n in nodes])
    p = marginals(unary, edges, model["pots"])
    for n, q in zip(nodes, p):
        best = int(q.argmax())
        if n[2] is None and best and q[best] >= sure:
            out[best - 1].append((n[0], n[1]))
    return out


def learn(docs: DataFrame, sample_docs: int = 20_000) -> dict:
    """Field weights from about ``sample_docs`` rows of (doc_id, text)."""
    n = docs.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("pii")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = docs.filter(F.col("doc_id").isNotNull() & (share * n < sample_docs)).select("text")

    def run(cols: dict[str, pa.Array]) -> dict:
        got = [training_rows(t.as_py() or "") for t in cols["text"]]
        return {"labels": [g and g[0] for g in got], "feats": [g and g[1] for g in got], "edges": [g and [list(e) for e in g[2]] for g in got]}

    rows = arrow_map(sample, run, "labels array<int>, feats array<array<int>>, edges array<array<int>>").filter("labels is not null")
    return fit([(r["labels"], r["feats"], r["edges"]) for r in rows.orderBy(F.xxhash64("labels", "feats")).collect()])


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, own in zip(KINDS, spans) for s, e in sorted(own))


def find_pii(docs: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, n_<kind>, base_sha256, spans and n_added of every row."""
    def run(cols: dict[str, pa.Array]) -> dict:
        out: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": [], "n_added": []}
        for t in cols["text"]:
            text = t.as_py() or ""
            base = base_spans(text)
            more = added_spans(text, base, model)
            for k, own in zip(KINDS, base):
                out[f"n_{k}"].append(len(own))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined([a + b for a, b in zip(base, more)]))
            out["n_added"].append(sum(map(len, more)))
        return {c: cols[c] for c in keep} | out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return arrow_map(docs.select(*dict.fromkeys([*keep, "text"])), run, fields + "".join(f", n_{k} long" for k in KINDS)
                     + ", base_sha256 string, spans string, n_added long")


def redact(text: str, model: dict) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    base = base_spans(text)
    spans = sorted((s, -e, k) for k, own in zip(KINDS, [a + b for a, b in zip(base, added_spans(text, base, model))]) for s, e in own)
    out, at = [], 0
    for s, e, k in spans:
        e = -e
        if s >= at:
            out += [text[at:s], f"<{k}>"]
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])
