"""Personal data in texts: four formats, and identifiers found by their context.

Built-in functions only. Spans of the formats (emails, addresses, cards, phones) are the seeds.
Every run of tokens with a digit or an ``@`` is a mention; the words around it and its shape
induce lexical patterns. Pattern and instance scores are computed in turns over the graph of
both: a pattern is as good as the share of its instances that are known, an instance as good
as its patterns together. Instances above the threshold whose patterns have enough distinct
known instances are new identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import filled_id, free_names, keyed, saved, text_key

KINDS = ("email", "ip", "card", "phone")
# The formats. Possessive quantifiers and the conditions in front only keep the search linear:
# a match that could start later in the same run of characters would fail like the first.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A cheap test that a text without a match most likely fails.
HINTS = {"email": "@", "phone": "+"}
HINT_PATTERNS = {"ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]"}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
TOKEN = r"[^\s0-9@]*+[0-9@]\S*+"
MENTION = rf"(?<!\S){TOKEN}(?: {TOKEN})*+"
CONTEXT_CHARS = 64
TURNS = 3
LEAST_SCORE = 0.8
LEAST_SEEDS = 3
KEY = ["id_key", "text_hash"]


def _pieces(text: Column, pattern: str, hint: Column) -> tuple[Column, Column]:
    """Matches of a pattern and the texts between them."""
    none = F.array().cast("array<string>")
    return (
        F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
        F.when(hint, F.split(text, pattern, -1)).otherwise(none),
    )


def _placed(matches: str, gaps: str) -> Column:
    """Matches with their start and end in code points."""
    state = "struct<at:bigint,found:array<struct<start:bigint,end:bigint,value:string>>>"
    return F.expr(
        f"""aggregate(
              zip_with({matches}, slice({gaps}, 1, size({matches})), (m, g) -> struct(m, g)),
              cast(struct(0, array()) as {state}),
              (done, x) -> cast(struct(
                done.at + char_length(x.g) + char_length(x.m),
                concat(done.found, array(named_struct(
                  'start', done.at + char_length(x.g),
                  'end', done.at + char_length(x.g) + char_length(x.m),
                  'value', x.m)))) as {state}),
              done -> done.found)"""
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Every second digit from the right is doubled; the sum of all digits ends in 0."""
    digits = F.split(F.reverse(_digits(value)), "")
    total = F.aggregate(
        F.transform(
            digits,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    count = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return F.when(count.between(13, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _only_valid(kind: str) -> Column:
    return F.filter(kind, lambda s: _valid(kind, s["value"]))


def _hint(kind: str, text: Column) -> Column:
    return F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike(HINT_PATTERNS[kind])


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, the row's key, its text, and per kind an array of ``(start, end, value)``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumns({"id_key": filled_id(F.col("doc_id")), "text_hash": text_key(F.col("text"))})
    parts = {}
    for kind in KINDS:
        matches, gaps = _pieces(F.col("text"), PATTERNS[kind], _hint(kind, F.col("text")))
        parts |= {f"{kind}_matches": matches, f"{kind}_gaps": gaps}
    rows = rows.withColumns(parts)
    placed = {k: _placed(f"{k}_matches", f"{k}_gaps") for k in KINDS}
    rows = rows.select("doc_id", *KEY, "text", *[c.alias(k) for k, c in placed.items()])
    return rows.withColumns({kind: _only_valid(kind) for kind in KINDS})


def mentions(spans: DataFrame) -> DataFrame:
    """Runs of identifier-like tokens with the words around them and the kind, if known.

    A mention is known if a base span of some kind lies over or in it.
    """
    text = F.col("text")
    matches, gaps = _pieces(text, MENTION, text.rlike("[0-9@]"))
    rows = spans.withColumns({"matches": matches, "gaps": gaps}).where(F.size("matches") > 0)
    rows = rows.select(*KEY, *KINDS, "gaps", _placed("matches", "gaps").alias("placed"))
    rows = rows.select(*KEY, *KINDS, "gaps", F.posexplode("placed").alias("i", "m"))
    left = F.split(F.trim(F.lower(F.right(F.get("gaps", F.col("i")), F.lit(CONTEXT_CHARS)))), r"\s+")
    right = F.split(
        F.trim(F.lower(F.left(F.get("gaps", F.col("i") + 1), F.lit(CONTEXT_CHARS)))), r"\s+"
    )
    known = F.coalesce(
        *[
            F.when(
                F.exists(k, lambda s: (s["start"] < F.col("m.end")) & (s["end"] > F.col("m.start"))),
                F.lit(k),
            )
            for k in KINDS
        ]
    )
    word = F.coalesce(F.get(left, F.size(left) - 1), F.lit(""))
    shape = F.regexp_replace(
        F.regexp_replace(F.col("m.value"), "[0-9]+", "9"), r"[^\s0-9@.+()\-]+", "a"
    )
    return rows.select(
        *KEY,
        F.col("m.start").alias("start"),
        # punctuation that closes a sentence is not part of an identifier
        (F.col("m.end") - F.length("m.value") + F.length(F.rtrim("m.value", F.lit(".,;:!?")))).alias("end"),
        F.lower(F.rtrim("m.value", F.lit(".,;:!?"))).alias("instance"),
        F.concat_ws(" ", F.coalesce(F.get(left, F.size(left) - 2), F.lit("")), word).alias("before"),
        F.concat_ws(" ", word, F.lit("_"), F.coalesce(F.get(right, F.lit(0)), F.lit(""))).alias("around"),
        shape.alias("shape"),
        known.alias("kind"),
    )


def _patterns(found: DataFrame) -> DataFrame:
    return found.select(
        "instance",
        "kind",
        F.explode(
            F.array(
                F.concat_ws("|", F.lit("before"), "before", "shape"),
                F.concat_ws("|", F.lit("around"), "around", "shape"),
            )
        ).alias("pattern"),
    )


def discover(found: DataFrame) -> DataFrame:
    """``(instance, kind)`` of identifiers that the base formats do not cover."""
    edges = saved(
        _patterns(found).groupBy("pattern", "instance").agg(F.max("kind").alias("seed")), "pii-edges"
    )
    # only patterns that hold a seed and something unknown can discover anything
    useful = (
        edges.groupBy("pattern")
        .agg(F.count("seed").alias("seeds"), F.count("*").alias("all"))
        .where((F.col("seeds") >= LEAST_SEEDS) & (F.col("all") > F.col("seeds")))
        .select("pattern")
    )
    edges = saved(edges.join(useful, "pattern"), "pii-graph")
    instances = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    scores = instances.where("seed IS NOT NULL").select(
        "instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")
    )
    for _ in range(TURNS):
        sizes = edges.groupBy("pattern").agg(F.count("*").alias("all"))
        sums = (
            edges.join(scores, "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("hits"), F.count("seed").alias("seeds"))
            .where(F.col("seeds") >= LEAST_SEEDS)
        )
        patterns = sums.join(sizes, "pattern").select(
            "pattern", "kind", (F.col("hits") / (F.col("all") + 1)).alias("quality")
        )
        doubt = F.exp(F.sum(F.log1p(-F.least("quality", F.lit(0.999999)))))
        scores = saved(
            edges.join(patterns, "pattern")
            .groupBy("instance", "kind")
            .agg((1 - doubt).alias("found"), F.max("seed").alias("seed"))
            .where("seed IS NULL OR seed = kind")
            .select("instance", "kind", F.expr("if(seed IS NULL, found, 1D)").alias("score")),
            "pii-scores",
        )
    new = scores.join(instances.where("seed IS NULL"), "instance").where(F.col("score") >= LEAST_SCORE)
    return new.groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _typed(kind: str) -> Column:
    return F.transform(
        kind,
        lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def find(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    The counts and the hash are of the base spans; ``spans`` (text) and ``all_spans`` (array of
    ``kind, start, end``) hold the discovered ones too. ``id_key`` and ``text_hash`` name the
    row. A null text is empty and has no spans, a null id stays null, repeated rows get the
    same result each, an empty table gives no rows, other columns are ignored. A text's spans
    are held as one array.
    """
    spans = base_spans(docs)
    base = F.concat(*[_typed(k) for k in KINDS])
    rows = saved(spans.select("doc_id", *KEY, base.alias("base")), "pii-base")
    seen = saved(mentions(spans), "pii-mentions")
    new = discover(seen)
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    added = (
        seen.where("kind IS NULL")
        .drop("kind")
        .join(new, "instance")
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    )
    whole = F.when(F.col("added").isNull(), F.col("base")).otherwise(
        F.transform(
            F.array_sort(
                F.transform(
                    F.concat("base", "added"),
                    lambda s: F.struct(
                        order[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
                        s["kind"].alias("kind"),
                    ),
                )
            ),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )
    )
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return (
        rows.join(saved(added, "pii-added"), KEY, "left")
        .withColumn("all_spans", whole)
        .select(
            "doc_id", *counts,
            F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
            _joined(F.col("all_spans")).alias("spans"),
            "all_spans", *KEY,
        )
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping ones by the first."""
    state = "struct<at:int,out:string>"
    ordered = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        )
    )
    done = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(state),
        lambda done, s: F.when(
            s["start"] >= done["at"],
            F.struct(
                s["end"].cast("int").alias("at"),
                F.concat(
                    done["out"],
                    F.substring(text, done["at"] + 1, s["start"].cast("int") - done["at"]),
                    F.lit("["), F.upper(s["kind"]), F.lit("]"),
                ).alias("out"),
            ),
        ).otherwise(
            F.struct(F.greatest(done["at"], s["end"].cast("int")).alias("at"), done["out"].alias("out"))
        ).cast(state),
    )
    rest = F.substring(text, done["at"] + 1, F.char_length(text))
    return F.when(F.size(spans) > 0, F.concat(done["out"], rest)).otherwise(text)


def mask_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with personal data masked in ``text`` and ``n_chars`` brought up to date.

    Null and empty texts stay as they are; rows with the same id and text are masked alike; of
    spans that overlap the first is written, and the characters of all of them go.
    """
    names = free_names(docs, "__pii_id", "__pii_text", "__pii_spans")
    found = (
        find(docs)
        .where(F.size("all_spans") > 0)
        .groupBy(*KEY)
        .agg(F.first("all_spans").alias(names[2]))
        .withColumnsRenamed(dict(zip(KEY, names)))
    )
    joined = keyed(docs, names[:2]).join(saved(found, "pii-found"), names[:2], "left")
    text = F.when(F.col(names[2]).isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col(names[2])))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.col(names[2]).isNotNull()
        out = out.withColumn(
            "n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return out.select(*[F.col(c) for c in docs.columns])
