"""Personal data by weak supervision: base patterns, and spans that labelers vote for.

Base spans (email, ip, card, phone) follow fixed rules and always stay.  Beyond them
looser candidates are gathered (secrets, phone numbers without a country code,
identity numbers, names).  For each candidate a pattern, a gazetteer, a context, a
shape and a repetition labeler vote yes, no or abstain.  Expectation-maximisation
over the counts of vote patterns estimates, for each kind, how far each labeler can
be trusted; its posteriors are the soft labels of a logistic span classifier over
surface features, which decides.  Counts and features are bounded tables, whatever
the corpus.

Scans are linear in the text: every pattern starts where a run starts, and runs are
taken whole.  Offsets are code points, ends exclusive.  Spans are listed by start,
then kind in the order of ``KINDS``.

Defined results: null and empty texts have no spans; rows that repeat a doc_id are
scanned each; an empty table gives an empty result; without candidates nothing is
added; only doc_id and text are read (:func:`redact` keeps all columns).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import slices, staged, text_of, tidied

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "local_phone", "identity", "name")
KINDS = BASE + ADDED
ADD_AT = 0.5

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])")
_IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
#: Frequent given names, titles and cue words.
GIVEN_NAMES = frozenset((
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph "
    "Jessica Thomas Sarah Charles Karen Daniel Nancy Paul Laura Anna Peter Hans Klaus Jürgen Wolfgang Monika Sabine "
    "Jean Pierre Marie Michel Sophie Claire Jacques Nicolas José María Carlos Ana Luis Carmen Antonio Pedro").split())
TITLES = frozenset("Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora Don Doña".split())
CUES = {
    "secret": frozenset("token secret key apikey api_key password passwd pwd bearer auth credential".split()),
    "local_phone": frozenset("tel phone call mobile cell fax telefon téléphone teléfono móvil handy".split()),
    "identity": frozenset("ssn social security passport identity id ausweis dni nif".split()),
    "name": frozenset("name contact author signed by from dear nom nombre kontakt".split()),
}
_WORD = re.compile(r"\w+")
YES, NO, ABSTAIN = 1, 0, 2
LABELERS = ("pattern", "gazetteer", "context", "shape", "repetition")
FEATURES = ("length", "digits", "upper", "lower", "opened", "cue", "varied", "separated")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans: leftmost, non-overlapping within a kind; failing matches are dropped."""
    out = []
    taken = 0
    for m in _AT.finditer(text):
        start = m.start()
        if start < taken:  # inside the address before
            continue
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            taken = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


_NAME_START = re.compile(r"(?<!\w)(?:%s)(?!\w)" % "|".join(sorted(GIVEN_NAMES | TITLES)))
_NAME_NEXT = re.compile(r"\.? ([A-ZÀ-ÖØ-Þ][^\W\d_]+)")


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, votes, features) of spans that touch no base span; votes and features are packed."""
    found: list[tuple[str, int, int]] = []
    for m in _SECRET.finditer(text):
        if any(c.isdigit() for c in m[0]):
            found.append(("secret", *m.span()))
    found += [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    found += [("identity", *m.span()) for m in _IDENTITY.finditer(text)]
    at = 0
    while m := _NAME_START.search(text, at):
        at = m.end()
        for _ in range(3):
            if not (follow := _NAME_NEXT.match(text, at)):
                break
            at = follow.end()
        if at > m.end():
            found.append(("name", m.start(), at))
    if not found:
        return []
    out, taken, seen = [], sorted((a, b) for _, a, b in base), {}
    k = 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue
        taken_before = out[-1][2] if out else 0
        if a < taken_before:  # the earlier candidate stays
            continue
        span = text[a:b]
        seen[span] = seen.get(span, 0) + 1
        votes, features = _look(kind, span, text[max(0, a - 24):a], seen[span])
        out.append((KINDS.index(kind), a, b, votes, features))
    return out


def _look(kind: str, span: str, left: str, times: int) -> tuple[int, int]:
    digits = sum(c.isdigit() for c in span)
    varied = len(set(span.lower()))
    cue = any(w.lower() in CUES[kind] for w in _WORD.findall(left)[-3:])
    opened = left[-1:] in ('"', "'", "=", ":", "(", "<", "[")
    first = re.split(r"\W", span, maxsplit=1)[0]
    if kind == "secret":
        pattern = YES if re.fullmatch(r"[0-9a-fA-F]{32,}", span) or (
            len(span) >= 24 and any(c.isupper() for c in span) and any(c.islower() for c in span)) else NO
        shape = YES if varied >= 10 else NO if varied <= 6 else ABSTAIN
    elif kind == "local_phone":
        pattern, shape = (YES if 9 <= digits <= 12 else NO), (YES if varied >= 5 else NO)
    elif kind == "identity":
        pattern = NO if span[:3] in ("000", "666") or span[0] == "9" else YES
        shape = YES if varied >= 4 else NO
    else:
        pattern = YES if all(w[:1].isupper() and w[1:].islower() for w in _WORD.findall(span)) else NO
        shape = NO if len(set(_WORD.findall(span))) < 2 else ABSTAIN
    gazetteer = (YES if first in GIVEN_NAMES else ABSTAIN) if kind == "name" else YES if cue else ABSTAIN
    context = (YES if first in TITLES or cue else ABSTAIN) if kind == "name" else \
        YES if opened else NO if left[-1:] in ("#", "/", "\\", "$") else ABSTAIN
    votes = 0
    for v in (pattern, gazetteer, context, shape, NO if times > 2 else ABSTAIN):
        votes = votes * 3 + v
    flags = (len(span) >= 32, digits > 0, any(c.isupper() for c in span), any(c.islower() for c in span), opened,
             cue, varied >= 10, sum(c in " .-" for c in span) >= 2)
    return votes, sum(f << k for k, f in enumerate(flags))


def unpack_votes(votes: int) -> tuple[int, ...]:
    out = []
    for _ in LABELERS:
        votes, v = divmod(votes, 3)
        out.append(v)
    return tuple(reversed(out))


@dataclass
class Classifier:
    """Logistic weights over the kind and the packed features, and what the labelers were found to be worth."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros((len(ADDED), len(FEATURES) + 1)))
    reliabilities: dict[str, list[tuple[float, float]]] = field(default_factory=dict)

    def accepts(self, kind: int, features: int) -> bool:
        w = self.weights[kind - len(BASE)]
        z = w[-1] + sum(w[k] for k in range(len(FEATURES)) if features >> k & 1)
        return 1 / (1 + np.exp(-z)) > ADD_AT


def estimate(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """Posterior of each vote pattern, and each labeler's chance to be right on (yes, no), by EM."""
    share = 0.5
    right = np.full((votes.shape[1], 2), 0.8)
    posterior = np.full(len(votes), 0.5)
    for _ in range(100):
        z = np.full(len(votes), np.log(share / (1 - share)))
        for k, (yes, no) in enumerate(right):
            z += np.where(votes[:, k] == YES, np.log(yes / (1 - no)), 0.0)
            z += np.where(votes[:, k] == NO, np.log((1 - yes) / no), 0.0)
        new = 1 / (1 + np.exp(-z))
        share = float(np.clip((1 + (new * counts).sum()) / (2 + counts.sum()), 0.02, 0.98))
        for k in range(len(right)):
            p, n = new * counts, (1 - new) * counts
            yes, no = votes[:, k] == YES, votes[:, k] == NO
            right[k] = np.clip([(4 + p[yes].sum()) / (5 + p[yes | no].sum()),
                                (4 + n[no].sum()) / (5 + n[yes | no].sum())], 0.55, 0.98)
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return posterior, [tuple(map(float, r)) for r in right]


def train(found: DataFrame) -> Classifier:
    """EM and classifier from the candidates' counts; ``found`` has the column ``candidates`` of :func:`scan`."""
    patterns = (found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes", "c.features")
                .count().toPandas().sort_values(["kind", "votes", "features"]))
    # At most kinds x 3 ** labelers x 2 ** features rows; in practice some hundreds.
    model = Classifier()
    for kind, own in patterns.groupby("kind"):
        votes = np.array([unpack_votes(int(v)) for v in own["votes"]]).reshape(-1, len(LABELERS))
        counts = own["count"].to_numpy(float)
        posterior, model.reliabilities[KINDS[kind]] = estimate(votes, counts)
        x = np.array([[f >> k & 1 for k in range(len(FEATURES))] + [1] for f in own["features"]], float)
        w = np.zeros(x.shape[1])
        share = counts / counts.sum()
        for _ in range(500):  # mean log loss with a small ridge
            w -= 2.0 * (x.T @ (share * (1 / (1 + np.exp(-x @ w)) - posterior)) + 1e-3 * w)
        model.weights[kind - len(BASE)] = w
    return model


_FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("base", T.ArrayType(T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())]))),
    T.StructField("candidates", T.ArrayType(T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("votes", T.IntegerType()),
        T.StructField("features", T.IntegerType())])))])
_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_CANDIDATE = pa.struct([*_SPAN, pa.field("votes", pa.int32()), pa.field("features", pa.int32())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        base, loose = [], []
        for value in batch.column(1):
            text = value.as_py()
            spans = base_spans(text)
            base.append([{"kind": KINDS.index(k), "start": a, "end": b} for k, a, b in spans])
            loose.append([dict(zip(("kind", "start", "end", "votes", "features"), c))
                          for c in candidates(text, spans)])
        yield pa.record_batch([batch.column(0), pa.array(base, pa.list_(_SPAN)), pa.array(loose, pa.list_(_CANDIDATE))],
                              names=["doc_id", "base", "candidates"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and candidates of each row: one pass over the texts."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text")) \
               .mapInArrow(_scan, _FOUND)


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2])))


def _report(model: Classifier, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for base, loose in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = [(s["kind"], s["start"], s["end"]) for s in base]
            added = [(c["kind"], c["start"], c["end"]) for c in loose if model.accepts(c["kind"], c["features"])]
            kinds = [k for k, _, _ in own]
            out.append((*(kinds.count(k) for k in range(len(BASE))),
                        hashlib.sha256(_listed(own).encode()).hexdigest(), _listed(own + added), len(added)))
        columns = list(zip(*out)) or [[]] * 7
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
        yield pa.record_batch([batch.column(0), *(pa.array(list(c), t) for c, t in zip(columns, kinds))],
                              names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, their digest, all spans, and the number of added ones."""
    found = staged(scan(docs), "pii-found")
    model = train(found)
    return found.mapInArrow(lambda it: _report(model, it), "doc_id bigint, " + ", ".join(
        f"n_{k} bigint" for k in BASE) + ", base_sha256 string, spans string, n_added bigint")


def redacted(text: str, model: Classifier) -> str:
    """The text with each span (overlapping ones together) replaced by its kind in angle brackets."""
    base = base_spans(text)
    spans = [(a, b, k) for k, a, b in base]
    spans += [(a, b, KINDS[k]) for k, a, b, _, f in candidates(text, base) if model.accepts(k, f)]
    out, at = [], 0
    for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = b
    return "".join([*out, text[at:]])


def _redact(model: Classifier, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        at = batch.schema.get_field_index("text")
        clean = [None if v.as_py() is None else redacted(v.as_py(), model) for v in batch.column(at)]
        yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind."""
    model = train(staged(scan(docs), "pii-found"))
    return docs.mapInArrow(lambda it: tidied(_redact(model, it)), docs.schema)
