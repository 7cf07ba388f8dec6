"""Personal data by weak supervision.

Strict patterns find the base spans; looser ones add candidates. Labelers vote on
each candidate: regular expressions on its shape, gazetteers of endings, prefixes
and ranges, and the words around it. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is, without any labels, and the
resulting probabilities train the span classifier that decides on the candidates.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.stage import below_share, id_and_text, per_batch, staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "shape", "gazetteer", "context", "border", "variety")
MAX_FIT = 5000  # candidates the classifier is fitted on, those with the least hashes
ADD_FROM = 0.9
NEAR = 40  # characters of context on either side
CONTEXT_BUCKETS = 64

# fixed values: what gazetteers and context labelers know
ENDINGS = frozenset("com org net edu gov mil int info biz io co me de fr es uk eu us ca ch at nl it pl se no jp cn in au br".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35")
CALLING = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")
WORDS_FOR = {
    "email": frozenset("email mail contact write reply correo courriel".split()),
    "ip": frozenset("ip address server host client login addr dirección serveur".split()),
    "card": frozenset("card visa mastercard amex payment credit debit tarjeta carte karte".split()),
    "phone": frozenset("phone call tel telephone mobile cell fax whatsapp telefon teléfono téléphone".split()),
}
WORDS_AGAINST = frozenset("version release license sha md5 token hash isbn build order invoice serial uuid id key".split())

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{1,3}[0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}
SHAPES = {
    "email": re.compile(r"[A-Za-z0-9][\w.%+-]*(?:@|\s?[\[(]at[\])]\s?)[A-Za-z0-9][\w-]*(?:.+)?[A-Za-z]{2,}", re.I),
    "ip": re.compile(r"(?!0)[0-9]{1,3}(?:\[?\.\]?(?:0|[1-9][0-9]{0,2})){3}"),
    "card": re.compile(r"[0-9]{13,19}|[0-9]{4}(?:\W{1,3}[0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}"),
    "phone": re.compile(r"\+?[0-9]{0,3}[\x20.-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,4}"),
}
DIGIT_OR_AT = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
NEARBY_WORD = re.compile(r"\w+")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@label.label..., each from the whole run of local characters before its @."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            past = domain.end()
            yield start, past
        at = text.find("@", max(at + 1, past))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of strict matches, by start, then kind. Every pattern runs in linear time."""
    found = [(s, e, "email") for s, e in _emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def candidates(text: str | None) -> list[tuple[int, int, str, bool]]:
    """Base spans, then loose matches that touch no base span nor one another; by start, then kind."""
    if not text or not DIGIT_OR_AT.search(text):
        return []
    base = [(s, e, k, True) for s, e, k in base_spans(text)]
    loose = sorted((m.start(), m.end(), k) for k in KINDS for m in LOOSE[k].finditer(text))
    taken = sorted((s, e) for s, e, _, _ in base)
    extra, i, past = [], 0, -1
    for s, e, k in loose:
        while i < len(taken) and taken[i][1] <= s:
            i += 1
        if s >= past and not any(b < e for b, _ in taken[i:i + 1]):
            extra.append((s, e, k, False))
            past = e
    return sorted(base + extra, key=lambda x: (x[0], KINDS.index(x[2])))


def votes(text: str, start: int, end: int, kind: str, strict: bool) -> list[int]:
    """-1, 0 or 1 of each labeler, in the order of LABELERS."""
    span, digits = text[start:end], _digits(text[start:end])
    around = {w.lower() for w in NEARBY_WORD.findall(text[max(0, start - NEAR):start]) + NEARBY_WORD.findall(text[end:end + NEAR])}
    if kind == "email":
        known = re.split(r"[\W_]+", span.rstrip(")]-"))[-1].lower() in ENDINGS
        varied = len(set(span)) > 5
    elif kind == "ip":
        known = digits[:1] not in ("", "0") and not span.startswith(("127.", "255.", "0."))
        varied = len(set(re.split(r"\D+", span))) > 2
    elif kind == "card":
        known = bool(ISSUERS.match(digits)) and luhn(digits)
        varied = len(set(digits)) > 3
    else:
        known = bool(CALLING.match(digits)) or span.startswith("(")
        varied = len(set(digits)) > 3
    context = 1 if around & WORDS_FOR[kind] else -1 if around & WORDS_AGAINST else 0
    before, after = text[start - 1:start], text[end:end + 1]
    joined = before.isalnum() or after.isalnum() or before in ("_", "=", "/") and before != "" or after == "_"
    return [1 if strict else 0, 1 if SHAPES[kind].fullmatch(span) else -1, 1 if known else -1, context, -1 if joined else 1,
            1 if varied else -1]


def features(text: str, start: int, end: int, kind: str, vote: list[int]) -> list[float]:
    span = text[start:end]
    out = [0.0] * (len(KINDS) + 3 * len(LABELERS) + 4 + CONTEXT_BUCKETS)
    out[KINDS.index(kind)] = 1.0
    for i, v in enumerate(vote):
        out[len(KINDS) + 3 * i + v + 1] = 1.0
    at = len(KINDS) + 3 * len(LABELERS)
    out[at:at + 4] = [1.0, min(len(span), 60) / 30, len(_digits(span)) / len(span), sum(not c.isalnum() for c in span) / len(span)]
    for word in NEARBY_WORD.findall(text[max(0, start - NEAR):start])[-3:]:
        out[at + 4 + zlib.crc32(word.lower().encode()) % CONTEXT_BUCKETS] += 0.3
    return out


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = 50) -> tuple[float, np.ndarray]:
    """Prior of a true span, and P(vote | class) by labeler, class and vote, from counts of vote patterns.

    Every pattern counts with all its spans. Smoothing by one vote keeps unseen votes possible.
    """
    rows = np.array(list(patterns), int).reshape(-1, len(LABELERS))
    n = np.array(list(patterns.values()), float)
    true = 1 / (1 + np.exp(-rows.sum(axis=1) / 1.5))  # the majority, to begin with
    prior, table = 0.5, np.full((len(LABELERS), 2, 3), 1 / 3)
    for _ in range(rounds):
        prior = (n @ true + 1) / (n.sum() + 2)
        for i in range(len(LABELERS)):
            for v in (-1, 0, 1):
                cast = n * (rows[:, i] == v)
                table[i, 1, v + 1], table[i, 0, v + 1] = cast @ true + 1, cast @ (1 - true) + 1
        table /= table.sum(axis=2, keepdims=True)
        true = posterior(rows, prior, table)
    return prior, table


def posterior(rows: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    rows = np.asarray(rows, int).reshape(-1, len(LABELERS))
    log = np.log([1 - prior, prior]) + sum(np.log(table[i, :, rows[:, i] + 1]) for i in range(len(LABELERS)))
    return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))


@dataclass
class SpanModel:
    reliability: dict[str, tuple[float, np.ndarray]]
    weights: np.ndarray

    def probability(self, x: list[list[float]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.array(x) @ self.weights, -500, 500)))


def fit_classifier(x: np.ndarray, soft: np.ndarray, rounds: int = 300, l2: float = 0.01) -> np.ndarray:
    """Logistic regression on probabilistic labels, by Newton steps damped with ``l2``."""
    w = np.zeros(x.shape[1])
    for _ in range(min(rounds, 30)):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - soft) / len(x) + l2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + l2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


FOUND = "array<struct<s:long,e:long,kind:string,base:boolean,votes:array<int>,x:array<float>>>"
_FOUND = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("kind", pa.string()), ("base", pa.bool_()),
                             ("votes", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))]))


def _voted(docs: DataFrame) -> DataFrame:
    """(doc_id, found): the candidates of each document row with votes and features, but no text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for text in batch.column(1).to_pylist():
            own = []
            for s, e, k, base in candidates(text):
                v = votes(text, s, e, k, base)
                own.append({"s": s, "e": e, "kind": k, "base": base, "votes": v, "x": features(text, s, e, k, v)})
            out.append(own)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _FOUND)], ["doc_id", "found"])

    return docs.mapInArrow(per_batch(run), f"doc_id long, found {FOUND}")


def fit_span_model(voted: DataFrame, max_fit: int = MAX_FIT) -> SpanModel:
    """Reliabilities from the vote patterns of all candidates; the classifier from ``max_fit`` of them.

    At most 3**6 patterns per kind come to the driver, and ``max_fit`` rows.
    """
    every = voted.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
    patterns: dict[str, dict[tuple[int, ...], int]] = {k: {} for k in KINDS}
    for row in every.groupBy("kind", "votes").count().collect():
        patterns[row["kind"]][tuple(row["votes"])] = row["count"]
    reliability = {k: reliabilities(p) for k, p in patterns.items() if p}
    order = F.xxhash64("doc_id", "s", "kind")
    total = sum(n for p in patterns.values() for n in p.values())
    rows = every.where(below_share(order, max_fit, total)).select(order.alias("o"), "doc_id", "s", "kind", "votes", "x").orderBy("o", "doc_id", "s", "kind").limit(max_fit).collect()
    width = len(KINDS) + 3 * len(LABELERS) + 4 + CONTEXT_BUCKETS
    if not rows:
        return SpanModel({}, np.zeros(width))
    soft = np.array([posterior(np.array([r.votes]), *reliability[r.kind])[0] for r in rows])
    return SpanModel(reliability, fit_classifier(np.array([r.x for r in rows], float), soft))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def personal_data(docs: DataFrame, max_fit: int = MAX_FIT, add_from: float = ADD_FROM) -> DataFrame:
    """Per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, span_list.

    Counts and digest are of the base spans, which always stay; ``spans`` also has the candidates that the
    classifier gives a probability of ``add_from`` or more. span_list has kind, start, end (code points, end
    exclusive) and that probability.

    Null or empty text has no spans. Rows with one doc_id are handled one by one, a null doc_id like any other. An
    empty table gives an empty result, and without candidates nothing is trained. Columns besides id and text are
    not read.
    """
    voted = staged(_voted(id_and_text(docs)), "pii-votes")
    model = docs.sparkSession.sparkContext.broadcast(fit_span_model(voted, max_fit))
    listed = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts, digests, texts, lists = {k: [] for k in KINDS}, [], [], []
        for found in batch.column(1).to_pylist():
            p = model.value.probability([f["x"] for f in found]) if found else []
            base = [(f["s"], f["e"], f["kind"]) for f in found if f["base"]]
            kept = [(f["s"], f["e"], f["kind"], float(q)) for f, q in zip(found, p) if f["base"] or q >= add_from]
            for k in KINDS:
                counts[k].append(sum(x[2] == k for x in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            texts.append(_joined([x[:3] for x in kept]))
            lists.append([{"kind": k, "start": s, "end": e, "p": q} for s, e, k, q in kept])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()),
             pa.array(texts, pa.string()), pa.array(lists, listed)],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "span_list"])

    return voted.mapInArrow(
        per_batch(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string,"
        " span_list array<struct<kind:string,start:long,end:long,p:double>>")
