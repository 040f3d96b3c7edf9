"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers, and a
span classifier is trained on what they agree on.

Base spans (e-mail, address of a machine, card, phone in their plain forms, with their checks) are always returned. The
candidates are these, the matches that failed the checks, and looser forms. Six labelers say yes, no or nothing to each:
its form, its edges, its checksum, a gazetteer, cue words before it, and the variety of its characters. Over all documents
Spark counts how often each pattern of votes occurs; from the counts, which are as few as there are patterns, EM
estimates how reliable each labeler is for each kind, and so how likely a pattern's spans are personal data. A logistic
regression of hashed features (votes, shape, neighbouring words) learns these likelihoods and decides on looser forms.
"""

from __future__ import annotations

import ipaddress
import re
import zlib
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, pieces, written

# The expressions of the base kinds, public number formats, and the labelers' word lists.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AT = re.compile(r"(?:\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20)", re.I)
MASKED_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63})+", re.I)
IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f:]{6,39}(?![\w:])")
LOCAL_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{2,5}\)\x20?|0[0-9]{1,4}[\x20/-]|[2-9][0-9]{2}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![\w-]|\.[0-9])")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)")
SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
TLDS = frozenset("com org net edu gov int info biz io de fr es uk eu at ch it nl be pt pl se no dk fi us ca mx ar br co cl au nz jp in".split())
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98", "351", "352", "353", "354", "358", "359", "370", "371", "372", "380", "385", "386", "420", "421", "852", "886", "966", "971", "972")
ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "30", "36", "38", "35", "50", "56", "57", "58", "6")
IBAN_LENGTHS = {"AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24}
CUES = {
    "email": "email e-mail mail contact write reach correo courriel mailto kontakt adresse",
    "ip": "ip address host server login client adresse dirección",
    "card": "card visa mastercard amex credit debit payment karte kreditkarte carte tarjeta",
    "phone": "phone tel telephone call mobile cell fax telefon handy anruf téléphone portable teléfono móvil llamar",
    "iban": "iban account bank konto compte cuenta transfer",
    "ssn": "ssn social security",
}
COUNTER_CUES = frozenset("order invoice version build isbn issn sku model serial part page chapter figure ref reference ticket case release firmware bestellung rechnung commande facture pedido factura versión".split())

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "email_masked", "ip_v6", "card_short", "phone_local", "iban", "ssn")
LABELERS = ("form", "edges", "checksum", "gazetteer", "cue", "variety")
#: What is believed of a labeler before any vote is seen: shares of no, nothing and yes among true, and among false spans.
BELIEF = {"checksum": ((0.01, 0.29, 0.7), (0.7, 0.2, 0.1)), "cue": ((0.03, 0.27, 0.7), (0.7, 0.2, 0.1))}
USUAL = ((0.1, 0.3, 0.6), (0.5, 0.3, 0.2))
#: Most that these labelers' no may be believed to happen to a true span; others are free.
RARE_NO = {"checksum": 0.01, "cue": 0.05}
WIDTH, SLICE = 4096, 1 << 20
_CUES = {f: frozenset(w.split()) for f, w in CUES.items()}
_WORDS = re.compile(r"[^\W\d_][\w-]*")


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool  # a base span
    failed: bool  # a base kind's match that failed its check; never returned
    votes: tuple[int, ...]
    features: tuple[int, ...]


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str):
    """Each @ with the run of local characters before it and labels after it: the leftmost match that has this @."""
    over, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > over and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            over = m.end()
            yield start, over
        at = text.find("@", max(at + 1, over))


def _masked_emails(text: str):
    for m in AT.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < 64 and text[start - 1] in LOCAL:
            start -= 1
        domain = MASKED_DOMAIN.match(text, m.end())
        if start < m.start() and domain and (m[0] != m[0].strip("\x20aAtT") or "dot" in re.split(r"[^a-z]", domain[0].lower())):
            yield start, domain.end()


def _is_ip6(s: str) -> bool:
    try:
        return s.count(":") > 1 and bool(ipaddress.IPv6Address(s))
    except ValueError:
        return False


def matches(text: str):
    """(kind, start, end, passed) of all candidates; passed is None where a form has no check."""
    for a, b in _emails(text):
        yield "email", a, b, True
    for a, b in _masked_emails(text):
        yield "email_masked", a, b, None
    for m in IP6.finditer(text):
        if _is_ip6(m[0]):
            yield "ip_v6", *m.span(), None
    for m in IP.finditer(text):
        yield "ip", *m.span(), all(len(p) < 4 and int(p or "0") < 256 for p in (q.lstrip("0") for q in m[0].split(".")))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19:
            yield "card", *m.span(), luhn(digits)
        elif 13 <= len(digits) <= 15:
            yield "card_short", *m.span(), luhn(digits)
    for m in PHONE.finditer(text):
        yield "phone", *m.span(), 8 <= len(_digits(m[0])) <= 15
    for m in LOCAL_PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 12:
            yield "phone_local", *m.span(), None
    for m in IBAN.finditer(text):
        s = m[0].replace(" ", "")
        yield "iban", *m.span(), int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    for m in SSN.finditer(text):
        yield "ssn", *m.span(), None


def _gazetteer(kind: str, span: str) -> int:
    known = None
    if kind in ("email", "email_masked"):
        known = re.split(r"[^a-z]+", span.lower())[-1] in TLDS
    elif kind == "ip":
        first, second = (int(p[-4:]) for p in span.split(".")[:2])
        known = not (first in (0, 10, 127) or first > 223 or (first, second) == (192, 168) or (first == 172 and 16 <= second < 32))
    elif kind in ("card", "card_short"):
        known = _digits(span).startswith(ISSUERS)
    elif kind == "phone":
        known = _digits(span).startswith(CALLING)
    elif kind == "phone_local":
        known = None if span[0] in "(0" else span[4] in "23456789"
    elif kind == "iban":
        known = IBAN_LENGTHS.get(span[:2]) == len(span.replace(" ", ""))
    elif kind == "ssn":
        known = span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00" and span[7:] != "0000"
    return 0 if known is None else 1 if known else -1


def family(kind: str) -> str:
    return kind.split("_")[0]


def judge(text: str, kind: str, start: int, end: int, passed: bool | None) -> Candidate:
    """The candidate with its votes and features."""
    span, before, after = text[start:end], text[max(0, start - 48) : start], text[end : end + 24]
    plain = kind in BASE_KINDS or kind in ("iban", "ssn")
    form = (1 if passed is not False else -1) if plain else 0
    near = (before[-1:] or " ") + (after[:1] or " ")
    glued = any(c.isalnum() or c == "_" for c in near) or (after[:1] in (".", "-") and after[1:2].isdigit())
    edges = -1 if glued else 1 if not near.strip(" \n\t\"'()[]<>,;:.!?|") else 0
    checksum = 0 if passed is None or kind == "email" else 1 if passed else -1
    words = [w.lower() for w in _WORDS.findall(before)]
    recent = words[-5:]
    if any(w in COUNTER_CUES for w in recent):
        cue = -1
    elif any(w in _CUES[family(kind)] for w in recent):
        cue = 1
    else:
        cue = 0 if kind in BASE_KINDS else -1
    body = _digits(span) if kind not in ("email", "email_masked", "ip", "ip_v6") else span
    steps = {(int(b) - int(a)) % 10 for a, b in zip(body, body[1:], strict=False)} if body.isdigit() else {0, 1}
    variety = -1 if len(set(body)) < 3 or len(steps) < 2 else 1
    votes = (form, edges, checksum, _gazetteer(kind, span), cue, variety)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", span))[:24]
    after_words = _WORDS.findall(after)
    named = [f"kind={kind}", f"shape={shape}", f"near={'9' if near[0].isdigit() else near[0]}{'9' if near[1].isdigit() else near[1]}"]
    named += [f"{kind}:{n}={v}" for n, v in zip(LABELERS, votes, strict=True)]
    named += [f"before={w}" for w in words[-2:]] + [f"after={w.lower()}" for w in after_words[:1]]
    features = tuple(sorted({zlib.crc32(n.encode()) % WIDTH for n in named}))
    return Candidate(kind, start, end, bool(kind in BASE_KINDS and passed), kind in BASE_KINDS and not passed, votes, features)


def candidates(text: str) -> list[Candidate]:
    """By kind, then start. Base spans are those with base."""
    found = [judge(text, *m) for m in matches(text)]
    return sorted(found, key=lambda c: (KINDS.index(c.kind), c.start))


def joined(spans) -> str:
    return ",".join(f"{c.kind}:{c.start}:{c.end}" for c in spans)


_SPAN = "struct<kind:string,start:long,end:long,base:boolean,failed:boolean,votes:array<int>,features:array<int>>"
FOUND_SCHEMA = f"doc_id long, found array<{_SPAN}>"
_ARROW_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("failed", pa.bool_()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))]))
REPORT_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(batches):
    for batch in (p for whole in batches for p in pieces(whole, SLICE)):
        found = [[vars(c) for c in candidates(t)] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW_FOUND)], ["doc_id", "found"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found) per row: the candidates in its whole text with their votes. A narrow map."""
    return id_text(docs, id_col, text_col).mapInArrow(_find, FOUND_SCHEMA)


def weigh_labelers(votes: np.ndarray, counts: np.ndarray, trust: float = 0.3, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over patterns of votes (-1, 0, 1), one a row, that occur so often.

    Returns each pattern's likelihood of a true span; reliability[labeler, vote + 1, truth], the share of votes among false
    and true spans; and the share of true spans. It begins with what BELIEF says of the votes of labelers that do
    not always say the same. BELIEF counts as much as trust
    times a class's votes: labelers that never disagree tell nothing of each other. RARE_NO bounds how often a checksum may
    fail, or a looser form stand without a cue, in a true span, so that many decoys don't pass for a class.
    """
    n, labelers = votes.shape
    weight = counts.astype(float)
    prior = np.array([BELIEF.get(name, USUAL) if trust else USUAL for name in LABELERS[:labelers]]).transpose(0, 2, 1)[:, :, ::-1]
    reliability, share = prior, 0.5
    onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    tells = (votes != votes[:1]).any(0)
    tells = tells if tells.any() else ~tells
    odds = np.einsum("nlv,lv->n", onehot[:, tells], np.log(prior[tells, :, 1] / prior[tells, :, 0]))
    likely = 1 / (1 + np.exp(-odds))
    for _ in range(rounds):
        truth = np.c_[1 - likely, likely] * weight[:, None]
        reliability = np.einsum("nlv,nt->lvt", onehot, truth) + (2 + trust * truth.sum(0)) * prior
        reliability /= reliability.sum(1, keepdims=True)
        for i, name in enumerate(LABELERS[:labelers]):
            if trust and name in RARE_NO and reliability[i, 0, 1] > RARE_NO[name]:
                rest = reliability[i, 1:, 1]
                reliability[i, :, 1] = [RARE_NO[name], *(rest / rest.sum() * (1 - RARE_NO[name]))]
        share = float(np.clip((truth[:, 1].sum() + 1) / (weight.sum() + 2), 0.02, 0.98))
        log = np.einsum("nlv,lvt->nt", onehot, np.log(reliability)) + np.log([1 - share, share])
        now = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        moved, likely = np.abs(now - likely).max(initial=0.0), now
        if moved < 1e-7:
            break
    return likely, reliability, share


@dataclass(frozen=True)
class Model:
    """The span classifier: likely(features) is the logistic of the sum of its weights."""

    weights: np.ndarray
    intercept: float
    reliability: dict[str, np.ndarray]

    def likely(self, features) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[list(features)].sum(), -50, 50))))


def train(found: DataFrame, sample: int = 20_000) -> Model:
    """The labelers' reliabilities for each kind from all candidates of find(), and the classifier from at most `sample` distinct rows of
    features, those with the smallest hashes, so that copies count once."""
    spark = found.sparkSession
    spans = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.features")
    # At most as many rows as there are patterns of six votes in ten kinds.
    patterns = spans.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    likely, reliability = {}, {}
    for name in KINDS:
        rows = [r for r in patterns if r.kind == name]
        if rows:
            p, reliability[name], _ = weigh_labelers(np.array([r.votes for r in rows]), np.array([r["count"] for r in rows]))
            likely |= {(name, tuple(r.votes)): float(v) for r, v in zip(rows, p, strict=True)}
    taught = spans.distinct().orderBy(F.xxhash64("kind", "votes", "features"), "features", "votes").limit(sample).collect()
    labels = [likely[r.kind, tuple(r.votes)] for r in taught]
    if not taught or max(labels) < 0.5 or min(labels) > 0.5:
        # One class only: nothing to tell apart, and the labelers' own likelihood is all there is.
        mean = float(np.clip(np.mean(labels), 0.01, 0.99)) if taught else 0.01
        return Model(np.zeros(WIDTH), float(np.log(mean / (1 - mean))), reliability)
    rows = [(Vectors.sparse(WIDTH, r.features, [1.0] * len(r.features)), y, w) for r, p in zip(taught, labels, strict=True) for y, w in ((1.0, p), (0.0, 1 - p)) if w > 1e-6]
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType())])
    fitted = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=60, standardization=False).fit(spark.createDataFrame(rows, schema))
    return Model(fitted.coefficients.toArray(), float(fitted.intercept), reliability)


def accepted(found: list[Candidate], model: Model, threshold: float) -> list[Candidate]:
    """Base spans, and looser ones that the classifier takes and that meet no base span or earlier taken one."""
    taken = [c for c in found if c.base]
    for c in sorted((c for c in found if not c.base and not c.failed), key=lambda c: (c.start, -c.end)):
        if all(c.end <= o.start or o.end <= c.start for o in taken) and model.likely(c.features) >= threshold:
            taken.append(c)
    return sorted(taken, key=lambda c: (KINDS.index(c.kind), c.start))


def _report(model: Model, threshold: float):
    def run(batches):
        for batch in batches:
            rows = []
            for found in batch.column("found").to_pylist():
                found = [Candidate(**c) for c in found]
                base = [c for c in found if c.base]
                rows.append([*(sum(c.kind == k for c in base) for k in BASE_KINDS), sha256(joined(base).encode()).hexdigest(), joined(accepted(found, model, threshold))])
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], [f.split()[0] for f in REPORT_SCHEMA.split(", ")])

    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None, threshold: float = 0.8) -> DataFrame:
    """Per row: how many base spans of each kind its whole text has, their digest, and all spans.

    model: a fitted one, else it is trained on these documents. Null and empty texts have no spans; equal rows give equal
    rows; null ids stay null; other columns are left out; an empty table gives none. Texts are read once; nothing but
    counts of votes and the bounded sample leaves the tasks.
    """
    found = written(find(docs, id_col, text_col), "personal")
    model = train(found) if model is None else model
    return found.mapInArrow(_report(model, threshold), REPORT_SCHEMA)


def redact(text: str, spans: list[Candidate]) -> str:
    """text with each span replaced by its kind in brackets; of overlapping ones the first stays."""
    out, over = [], 0
    for c in sorted(spans, key=lambda c: (c.start, -c.end)):
        if c.start >= over:
            out += [text[over : c.start], f"[{c.kind.upper()}]"]
            over = c.end
    return "".join(out) + text[over:]
