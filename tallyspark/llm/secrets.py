"""Secret scan: candidates from words, judged by a random forest written as SQL conditions.

A candidate is a word of at least ``MIN_CHARS`` characters that contains a digit, one that assigns
to a secret's name, one that follows such a name and ``=``, ``:`` or ``is``, or an address with a password
(``://user:password@``). Its features are its length, the transitions between its characters, how much of it dictionary
words cover, whether it looks like a path, address or domain, and what its neighbouring words say.
The forest learns from labelled findings; where none are given, findings are labelled by what is
certain: a fixed key format or an assignment to a secret's name is a secret, any other address, path, number
or word is not; what follows a name and ``is`` and has lower-case letters only has no label. ``findings`` lists spans,
``redact`` takes the secrets out of the texts: long ones with a digit wherever they occur, others where they follow a
secret's name or a user, since they may be ordinary words or parts of some.

Such labels come from some of the features, which would then be all that the forest learns. So each labelled finding
is learned from twice, once with those features hidden, which leaves its form: length, kinds of characters and their
transitions, dictionary coverage. ``agreement`` measures that view on labelled findings held apart.

Texts are scanned once: candidates and their features are stored, and learning and judging read those. Scoring is done
inside the row, by functions on arrays: no shuffle, no Python on the executors. Learning uses the ``sample_rows`` labelled
findings with the smallest hash.

Defined results: null and blank texts have no findings; equal words are found as often as they occur;
repeated rows each have theirs; without labelled findings of both kinds every one is scored by its
label; an empty table gives no rows; further columns are kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

SAMPLE_ROWS = 4000
MIN_CHARS = 14
TREES = 15
DEPTH = 5
MASK = "[SECRET]"

# Well-known key formats, and names that announce a secret.
KEY_FORMATS = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abprs]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_-]{35}"
    r"|sk_live_[0-9A-Za-z]{16,}|eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]*"
)
SECRET_NAMES = r"passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential"
# Placeholders that stand where a secret would.
PLACEHOLDERS = r"example|sample|dummy|test|changeme|placeholder|xxxx|redacted|your[_-]"
# What stands between a name and the secret in a later word, at the end of what is before the secret.
FOLLOWS = rf"(?i)(?:{SECRET_NAMES})[\"']?\s*"
USER_INFO = r"://[^/\s:@]*:([^/\s@]+)@"
COMMON_PARTS = r"the|ing|and|ion|ent|for|tion|com|net|org|www|http|html|user|mail|file|page|name|data|index|image"

FEATURES = [
    "n_chars", "digit_share", "upper_share", "lower_share", "transitions", "distinct", "longest_word", "covered",
    "hex_only", "digits_only", "path", "address", "key_format", "named", "named_before", "quoted", "placeholder",
]


def _gap(text: Column, pattern: str) -> Column:
    """Number of characters that matches of ``pattern`` cover."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("double")


def is_long(word: Column) -> Column:
    """Whether a word is a candidate by itself: a value like it is no ordinary word."""
    return (F.char_length(word) >= MIN_CHARS) & word.rlike("[0-9]")


def candidates() -> Column:
    """Array of (place, word, before) of those of _words that may hold a key."""
    words, none = F.col("_words"), F.lit("")
    placed = F.transform(words, lambda w, i: F.struct(i.alias("place"), w.alias("word")))
    # pairs of arrays, not places looked up, so that the array of words is made once for each
    one = F.zip_with(placed, F.concat(F.array(none), words), lambda c, p: F.struct(c["place"].alias("place"), c["word"].alias("word"), p.alias("p")))
    two = F.zip_with(
        one, F.concat(F.array(none, none), words),
        lambda c, q: F.struct(c["place"].alias("place"), c["word"].alias("word"), c["p"].alias("p"), q.alias("q")),
    )
    assigns = rf"(?i)(?:{SECRET_NAMES})[\"']?[=:][\"']?[^\"'=:]{{4,}}"

    def kept(c: Column) -> Column:
        word, p = c["word"], c["p"]
        ends = p.endswith("=") | p.endswith(":") | p.endswith("is") | p.endswith("IS") | p.endswith("Is") | p.endswith("iS")
        follows = ends & F.concat_ws(" ", c["q"], p).rlike(rf"{FOLLOWS}(?:[=:]+|\bis)$") & ~word.rlike("^[=:]+$")
        return is_long(word) | word.rlike(assigns) | (word.contains("://") & word.rlike(USER_INFO)) | follows

    found = F.filter(F.filter(two, lambda c: c["word"].isNotNull()), kept)
    return F.transform(found, lambda c: F.struct(c["place"].alias("place"), c["word"].alias("word"), F.concat_ws(" ", c["q"], c["p"]).alias("before")))


def value_of(word: Column) -> Column:
    """The key itself: what follows a name and an equals sign or colon, without quotes and marks; of an
    address with a password, the password."""
    bare = F.regexp_replace(word, rf"^[\"'(\[{{<]*(?:[A-Za-z_.-]{{1,40}}[=:]+)?[\"'(\[{{<]*|[\"')\]}}>.,;:!?]+$", "")
    return F.when(word.rlike(USER_INFO), F.regexp_extract(word, USER_INFO, 1)).when(F.char_length(bare) > 0, bare).otherwise(word)


def measured(c: Column) -> list[Column]:
    """FEATURES of a candidate, as doubles."""
    value, word = c["value"], c["word"]
    n = F.greatest(F.char_length(value), F.lit(1)).cast("double")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[A-Z]+", "8"), "[a-z]+", "7")
    flag = lambda x: x.cast("double")
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return [
        F.char_length(value).cast("double"),
        _gap(value, "[0-9]+") / n,
        _gap(value, "[A-Z]+") / n,
        _gap(value, "[a-z]+") / n,
        F.char_length(kinds).cast("double") / n,
        distinct.cast("double") / n,
        F.array_max(F.transform(F.split(value, "[^a-z]+"), lambda p: F.char_length(p))).cast("double"),
        _gap(F.lower(value), COMMON_PARTS) / n,
        flag(value.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$")),
        flag(value.rlike(r"^[0-9.,:/+-]+$")),
        flag(word.rlike(r"://|^/|[A-Za-z]/[A-Za-z].*/|\\")),
        flag(word.rlike(r"@|\.[A-Za-z]{2,6}(?:[/?#:]|$)")),
        flag(value.rlike(f"^(?:{KEY_FORMATS})$")),
        flag(word.rlike(rf"(?i)(?:{SECRET_NAMES})[\"']?[=:]") | word.rlike(USER_INFO)),
        F.when(c["before"].rlike(rf"{FOLLOWS}[=:]+$"), 3.0).when(c["before"].rlike(rf"{FOLLOWS}\bis$"), 2.0)
        .when(c["before"].rlike(rf"{FOLLOWS}$"), 1.0).otherwise(0.0),  # the surer the name says so
        flag(word.rlike(r"^[\"'].*[\"'][.,;)]*$")),
        flag(F.lower(value).rlike(PLACEHOLDERS)),
    ]


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _found: candidates with their features, one array per row."""
    words = F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    found = docs.withColumn("_words", words).withColumn("_candidates", candidates())
    valued = F.transform(
        "_candidates",
        lambda c: F.struct(c["place"].alias("place"), c["word"].alias("word"), value_of(c["word"]).alias("value"), c["before"].alias("before")),
    )
    found = found.drop("_words").withColumn("_valued", valued).drop("_candidates")
    features = F.transform(
        "_valued", lambda c: F.struct(*[c[k].alias(k) for k in ("place", "word", "value")], *[m.alias(n) for n, m in zip(FEATURES, measured(c))])
    )
    return found.withColumn("_found", features).drop("_valued")


def _with_found(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` scanned, unless they are already."""
    return docs if "_found" in docs.columns else scanned(docs, text)


def certain_label(c: Column) -> Column:
    """1 for a certain secret, 0 for a certain false positive, else null."""
    secret = (c["key_format"] == 1) | (c["named"] == 1) | (c["named_before"] == 3) | ((c["named_before"] == 2) & (c["lower_share"] < 1))
    plain = (c["address"] == 1) | (c["path"] == 1) | (c["digits_only"] == 1)
    by_name = F.when(c["placeholder"] == 1, 0).when(secret, 1).when(plain, 0).when(c["named_before"] == 1, 1)
    return by_name.when((c["transitions"] < 0.2) & (c["named_before"] == 0), 0)


@dataclass(frozen=True)
class Node:
    feature: int = -1
    value: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None
    share: float = 0.0

    def sql(self, name: str) -> str:
        if self.low is None:
            return f"{self.share:.6f}D"
        return f"CASE WHEN {name}.{FEATURES[self.feature]} <= {self.value!r}D THEN {self.low.sql(name)} ELSE {self.high.sql(name)} END"

    def predict(self, row: np.ndarray) -> float:
        if self.low is None:
            return self.share
        return (self.low if row[self.feature] <= self.value else self.high).predict(row)


def _tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> Node:
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 4:
        return Node(share=share)
    best = (share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    for f in rng.choice(x.shape[1], max(2, int(np.ceil(np.sqrt(x.shape[1])))) + 1, replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        n = cut + 1
        left, right = ones[cut], ones[-1] - ones[cut]
        impurity = left * (n - left) / n + right * (len(y) - n - right) / (len(y) - n)
        k = int(impurity.argmin())
        if impurity[k] < best[0]:
            best = (float(impurity[k]), int(f), float((v[cut[k]] + v[cut[k] + 1]) / 2))
    if best[1] < 0:
        return Node(share=share)
    low = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], _tree(x[low], y[low], rng, depth - 1), _tree(x[~low], y[~low], rng, depth - 1))


def forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Node]:
    """Trees on bootstrap rows, each split on a random choice of features. None without both kinds."""
    if not len(y) or y.min() == y.max():
        return []
    rng = np.random.default_rng(7)
    return [_tree(x[rows], y[rows], rng, depth) for rows in (rng.integers(0, len(y), len(y)) for _ in range(trees))]


#: Features that ``certain_label`` reads.
EVIDENCE = ["key_format", "named", "named_before", "path", "address", "digits_only", "placeholder"]


def without_evidence(x: np.ndarray) -> np.ndarray:
    """Rows of features with those hidden that labels are made of."""
    hidden = x.copy()
    hidden[:, [FEATURES.index(n) for n in EVIDENCE]] = 0.0
    return hidden


def labelled_rows(docs: DataFrame, text: str = "text", labelled: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``sample_rows`` distinct findings, as many of either kind at most."""
    rows = (docs if "_found" in docs.columns else scanned(docs.select(text), text)).select(F.explode("_found").alias("c"))
    if labelled is None:
        rows = rows.withColumn("label", certain_label(F.col("c")))
    else:
        known = labelled.groupBy(F.col("value").alias("_value")).agg(F.max(F.col("is_secret").cast("int")).alias("label"))
        rows = rows.join(known, F.col("c.value") == F.col("_value"))
    flat = rows.where("label is not null").select("label", "c.value", *[f"c.{n}" for n in FEATURES]).distinct()
    columns, out = ["label", *FEATURES], []
    for label in (0, 1):
        out += flat.where(F.col("label") == label).orderBy(F.xxhash64("value"), *columns).limit(sample_rows // 2).select(*columns).collect()
    data = np.array([list(r) for r in out], float).reshape(len(out), len(columns))
    return data[:, 1:], data[:, 0]


def learned(x: np.ndarray, y: np.ndarray) -> list[Node]:
    """The forest of labelled findings, each seen with and without the evidence."""
    return forest(np.vstack([x, without_evidence(x)]), np.concatenate([y, y]))


def train(docs: DataFrame, text: str = "text", labelled: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> list[Node]:
    """The forest from labelled findings (value, is_secret), or else from certain labels.

    Equal numbers of either kind are sampled, so that rare secrets are learned as well.
    """
    return learned(*labelled_rows(docs, text, labelled, sample_rows))


def agreement(x: np.ndarray, y: np.ndarray, share: int = 4) -> tuple[float, float]:
    """Precision and recall on every ``share``-th labelled finding, its evidence hidden, of a forest learned from the others."""
    held = np.arange(len(y)) % share == 0
    trees = learned(x[~held], y[~held])
    said = np.array([np.mean([t.predict(r) for t in trees]) >= 0.5 for r in without_evidence(x[held])])
    right = (said & (y[held] == 1)).sum()
    return right / max(1, said.sum()), right / max(1, (y[held] == 1).sum())


def score(trees: list[Node], name: str) -> Column:
    """Mean share of secrets in the leaves of candidate ``name``; its certain label without trees."""
    if not trees:
        return F.coalesce(certain_label(F.col(name)), F.lit(0)).cast("double")
    return F.expr("(" + " + ".join(t.sql(name) for t in trees) + f") / {len(trees)}D")


def judged(docs: DataFrame, trees: list[Node], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with findings: array of (place, value, score, is_secret); place counts words."""
    total = "(" + " + ".join(t.sql("c") for t in trees) + f") / {len(trees)}D" if trees else "0D"
    if trees:
        scored = F.expr(f"transform(_found, c -> named_struct('place', c.place, 'value', c.value, 'score', {total}))")
    else:
        scored = F.transform("_found", lambda c: F.struct(c["place"].alias("place"), c["value"].alias("value"), F.coalesce(certain_label(c), F.lit(0)).cast("double").alias("score")))
    found = _with_found(docs, text).withColumn("_scored", scored).drop("_found")
    return found.withColumn(
        "findings",
        F.transform("_scored", lambda c: F.struct(c["place"], c["value"], c["score"], (c["score"] >= threshold).alias("is_secret"))),
    ).drop("_scored")


def redact(docs: DataFrame, trees: list[Node] | None = None, text: str = "text", count: str = "n_secrets") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by a mask, and their number in ``count``. Without ``trees``
    the forest is learned from the same scan."""
    given = [c for c in docs.columns if c != count]
    names = [c if c == text else f"c{i}" for i, c in enumerate(given)]  # so that no name clashes with one made here
    own = docs.select(*given).toDF(*names)
    if trees is None:
        own = materialise(scanned(own, text))
        trees = train(own, text)
    found = judged(own, trees, text)
    secrets = found.withColumn("_secrets", F.array_distinct(F.transform(F.filter("findings", lambda c: c["is_secret"]), lambda c: c["value"])))
    # longer values first, so that none is cut by one it contains
    ordered = secrets.withColumn("_ordered", F.reverse(F.array_sort(F.transform("_secrets", lambda v: F.struct(F.char_length(v), v.alias("v"))))))
    opened = rf"((?:{FOLLOWS}(?:[=:]+|\bis)?\s*|://[^/\s:@]*:)[\"'(\[{{<]*)"

    def mask(t: Column, v: Column) -> Column:
        everywhere = F.replace(t, v, F.lit(MASK))
        quoted = F.concat(F.lit(r"\Q"), F.replace(v, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        named = F.regexp_replace(t, F.concat(F.lit(opened), quoted, F.lit(r"(?![A-Za-z0-9])")), F.lit(rf"$1{MASK}"))
        return F.when(is_long(v), everywhere).when(named != t, named).otherwise(everywhere)

    masked = F.aggregate("_ordered", F.col(text), lambda t, s: mask(t, s["v"]))
    return ordered.select(
        *[F.when(F.size("_secrets") > 0, masked).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in names],
        F.size("_secrets").alias(count),
    ).toDF(*given, count)


def findings(docs: DataFrame, trees: list[Node] | None = None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, place (word number from 0), value, score, is_secret. Without ``trees`` the
    forest is learned from the same scan."""
    found = scanned(docs.select("doc_id", text), text).drop(text)
    if trees is None:
        found = materialise(found.where(F.size("_found") > 0))
        trees = train(found, text)
    return judged(found, trees, text, threshold).select("doc_id", F.inline("findings"))
