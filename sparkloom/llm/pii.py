"""Personal data: base patterns give seeds, seeds induce contexts, and reliable contexts find further identifiers, in rounds.

DataFrame functions only. Places are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KINDS = ["email", "ip", "card", "phone"]

# The base patterns, written so that none tries a place twice: a run of characters is taken whole, and a match starts
# where a run starts or the last match ended. What they match is the same.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
#: Words that may be identifiers, of any kind: runs of letters, digits and signs within words, with a digit; LEAST_LENGTH
#: characters at least. A run is tried once, where it begins.
CANDIDATE = r"(?<![\p{L}\p{N}_.-])(?=[\p{L}_.-]*+\p{N})[\p{L}\p{N}_.-]*[\p{L}\p{N}]"
LEAST_LENGTH = 6
#: Other forms of each kind that the base patterns refuse: a host without dots or spelt-out signs, groups of hexadecimal
#: digits, cards and phones with separators. What a text must hold for each.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![A-Za-z0-9.:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![A-Za-z0-9:])",
    "card": r"(?<![0-9])[0-9]{2,6}(?:[ .-][0-9]{2,6}){2,7}(?![0-9])",
    "phone": r"(?<![0-9+(])\+?\(?[0-9]{1,5}\)?(?:[ ./-]{1,2}\(?[0-9]{1,5}\)?){1,6}(?![0-9])",
}
FORM_NEEDS = {"email": r"@|[(\[]at[)\]]", "ip": "[0-9A-Fa-f]:[0-9A-Fa-f:]", "card": "[0-9][ .-][0-9]", "phone": r"[0-9]\)?[ ./-]"}
#: Patterns up to which they are broadcast against the words of all texts; more are joined by a shuffle.
BROADCAST_ROWS = 300_000
#: So many spans share one partial sum, so that places are found in about linear time.
BLOCK = 128
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value, context>> of all matches, from the gaps between them."""
    gaps = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.struct(gaps.alias("gaps"), values.alias("matches"))


def _spans(cut: str) -> str:
    """SQL for the spans of a column that _located() made; null stays null."""
    steps = f"transform(sequence(0, size({cut}.matches) - 1), i -> char_length({cut}.gaps[i]) + char_length({cut}.matches[i]))"
    blocks = f"""transform(sequence(0, (size({cut}.matches) - 1) div {BLOCK}),
                 b -> aggregate(slice(steps, b * {BLOCK} + 1, {BLOCK}), 0, (t, x) -> t + x))"""
    begins = "aggregate(sums, array(0), (t, x) -> array_append(t, element_at(t, -1) + x))"
    place = f"""begins[i div {BLOCK}] + aggregate(slice(steps, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0, (t, x) -> t + x)
                + char_length({cut}.gaps[i])"""
    ahead, behind, match = f"{cut}.gaps[i]", f"{cut}.gaps[i + 1]", f"{cut}.matches[i]"
    after = f"regexp_extract({match} || regexp_extract({behind}, '^\\\\S*+', 0), '^\\\\S++', 0)"
    before = f"regexp_extract(regexp_extract({ahead}, '(?<!\\\\S)\\\\S++$', 0) || {match}, '(?<!\\\\S)\\\\S++$', 0)"
    span = f"""named_struct('start', start, 'end', start + char_length({match}), 'value', {match},
               'left', lower(regexp_extract({ahead}, '(?<!\\\\S)(\\\\S++)\\\\s*+$', 1)), 'after', xxhash64(lower({after})),
               'right', lower(regexp_extract({behind}, '^\\\\s*+(\\\\S++)', 1)), 'before', xxhash64(lower({before})))"""
    # a one-element transform binds a value for the lambda inside it
    spans = f"transform(sequence(0, size({cut}.matches) - 1), i -> transform(array({place}), start -> {span})[0])"
    bound = f"transform(array({steps}), steps -> transform(array({blocks}), sums -> transform(array({begins}), begins -> {spans})[0])[0])[0]"
    return f"case when size({cut}.matches) > 0 then {bound} end"


def _luhn(value: str) -> str:
    """SQL: digits of `value` pass the Luhn test."""
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    term = "(int(substring(d, length(d) - i, 1)) * (1 + i % 2))"
    return f"transform(array({digits}), d -> aggregate(sequence(0, length(d) - 1), 0L, (t, i) -> t + {term} div 10 + {term} % 10) % 10 = 0)[0]"


def _digits(value: str) -> str:
    return f"length(regexp_replace({value}, '[^0-9]', ''))"


KEEP = {
    "email": "true",
    "ip": f"x.value rlike '^{OCTET}(\\\\.{OCTET}){{3}}$'",
    "card": f"{_digits('x.value')} between 12 and 19 and {_luhn('x.value')}",
    "phone": f"{_digits('x.value')} between 9 and 15",
}
#: The forms of a kind that may be identifiers.
KEEP_FORM = {"email": "true", "ip": "x.value rlike '[0-9]'", "card": f"{_digits('x.value')} between 12 and 19", "phone": f"{_digits('x.value')} between 7 and 15"}
FIELDS = {"start": "int", "end": "int", "value": "string", "left": "string", "after": "bigint", "right": "string", "before": "bigint"}
SPAN = f"array<struct<{','.join(f'{k}:{v}' for k, v in FIELDS.items())}>>"
OTHER = f"array<struct<{','.join(f'{k}:{v}' for k, v in FIELDS.items())},of:string>>"


def base_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False) -> DataFrame:
    """doc_id, row_number_, a column of spans for each kind, and `candidates`: other words that may be identifiers,
    of any kind where `of` is null; with `keep_rows` also `row_`, the whole row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = [F.struct(*(docs[c] for c in docs.columns)).alias("row_")] if keep_rows else []
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row_number_"), *whole)
    for kind in KINDS:
        need = F.rlike("text", F.lit(NEEDS[kind]))
        rows = rows.withColumn(f"{kind}_cut", F.when(need, _located(F.col("text"), PATTERNS[kind])))
    rows = rows.withColumn("candidates_cut", F.when(F.rlike("text", F.lit(r"\p{N}")), _located(F.col("text"), CANDIDATE)))
    for kind in KINDS:
        rows = rows.withColumn(kind, F.expr(_spans(f"{kind}_cut")))
        rows = rows.withColumn(kind, F.expr(f"coalesce(filter({kind}, x -> {KEEP[kind]}), cast(array() as {SPAN}))"))
    for kind in KINDS:
        rows = rows.withColumn(f"{kind}_forms_cut", F.when(F.rlike("text", F.lit(FORM_NEEDS[kind])), _located(F.col("text"), FORMS[kind])))
    others = []
    for name, of, keep in [("candidates", "null", f"char_length(x.value) >= {LEAST_LENGTH}"), *((f"{k}_forms", f"'{k}'", KEEP_FORM[k]) for k in KINDS)]:
        rows = rows.withColumn(f"{name}_spans", F.expr(_spans(f"{name}_cut")))
        struct = f"named_struct({', '.join(f'{k!r}, x.{k}' for k in FIELDS)}, 'of', cast({of} as string))"
        others.append(f"transform(filter(coalesce({name}_spans, cast(array() as {SPAN})), x -> {keep}), x -> {struct})")
    rows = rows.withColumn("candidates", F.expr(f"concat({', '.join(others)})"))
    # bound by a one-element transform, or else the optimizer would put how they are made into the inner lambda
    apart = " and ".join(f"not exists(z.{k}, b -> b.start < x.end and x.start < b.end)" for k in KINDS)
    bound = f"array(struct(candidates, {', '.join(KINDS)}))"
    rows = rows.withColumn("candidates", F.expr(f"case when size(candidates) = 0 then cast(array() as {OTHER}) else transform({bound}, z -> filter(z.candidates, x -> {apart}))[0] end"))
    return rows.select("doc_id", "row_number_", *KINDS, "candidates", *["row_"] * keep_rows)


def _words_around(docs: DataFrame, contexts: DataFrame, text_col: str) -> DataFrame:
    """side, context, word (a hash): the distinct words, or parts of words, that stand after the given left contexts and
    before the given right ones in all texts. contexts: side, context; a stored table."""
    longest = contexts.agg(F.max(F.length("context"))).first()[0] or 0
    known = contexts.groupBy(F.col("context").alias("known")).agg(F.max((F.col("side") == "left").cast("int")).alias("on_left"), F.max((F.col("side") == "right").cast("int")).alias("on_right"))
    few = contexts.count() <= BROADCAST_ROWS
    small = F.broadcast if few else (lambda x: x)
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s+"), lambda w: w != "")
    # neighbours are zipped to the words, so that no array is copied for each of its words
    zipped = docs.select(words.alias("w")).filter(F.size("w") > 1).select(F.expr("inline(arrays_zip(w, concat(slice(w, 2, size(w) - 1), array('')), concat(array(''), slice(w, 1, size(w) - 1))))").alias("word", "next", "last"))
    # a context is a whole word, or what a word begins or ends with up to a sign; none is longer than the longest asked for
    inner = "word rlike '[^\\\\p{L}\\\\p{N}_].'"
    hits = zipped.join(small(known), F.col("word") == F.col("known"), "left").filter(f"known is not null or {inner}")
    sign = "substring(word, p, 1) rlike '[^\\\\p{L}\\\\p{N}_]'"
    row = lambda side, context, other: f"struct('{side}' as side, {context} as context, {other} as other)"
    begins = f"transform(filter(sequence(1, least(length(word) - 1, {longest})), p -> {sign}), p -> {row('left', 'left(word, p)', 'substring(word, p + 1)')})"
    ends = f"transform(filter(sequence(greatest(2, length(word) - {longest} + 1), length(word)), p -> {sign}), p -> {row('right', 'substring(word, p)', 'left(word, p - 1)')})"
    none = "cast(array() as array<struct<side:string,context:string,other:string>>)"
    parts = [f"case when on_left = 1 then array({row('left', 'word', 'next')}) else {none} end", f"case when on_right = 1 then array({row('right', 'word', 'last')}) else {none} end", f"case when {inner} then concat({begins}, {ends}) else {none} end"]
    found = hits.select(F.explode(F.expr(f"concat({', '.join(parts)})")).alias("x")).select("x.*").filter("other <> ''")
    found = found.join(small(contexts), ["side", "context"], "left_semi")
    return found.select("side", "context", F.xxhash64("other").alias("word")).distinct()


def _edges(spans: DataFrame) -> DataFrame:
    """side, context, value, kind (of base spans, else null), of (the kind a candidate may be, null: any) and word: the
    distinct ones, so that a hot context or a value repeated in a third of all rows counts once a task before the shuffle."""
    own = "s.value, s.left, s.after, s.right, s.before"
    parts = [spans.select(F.explode(k).alias("s"), F.lit(k).alias("kind"), F.lit(None).cast("string").alias("of")).selectExpr(own.split(", ")[0], "kind", "of", *own.split(", ")[1:]) for k in KINDS]
    parts.append(spans.select(F.explode("candidates").alias("s")).selectExpr("s.value", "cast(null as string) as kind", "s.of as of", *own.split(", ")[1:]))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    sides = "array(named_struct('side', 'left', 'context', left, 'word', after), named_struct('side', 'right', 'context', right, 'word', before))"
    rows = every.select(F.lower("value").alias("value"), "kind", "of", F.explode(F.expr(sides)).alias("x")).select("x.side", "x.context", "value", "kind", "of", "x.word")
    # a pattern has a letter: signs alone say nothing
    return rows.filter(F.col("context").rlike(r"\p{L}")).distinct()


def discovered(spans: DataFrame, docs: DataFrame, *, rounds: int, least_seeds: int, least_confidence: float, least_share: float, text_col: str = "text") -> DataFrame:
    """kind, value and score of identifiers that patterns find.

    A pattern is the word before a match or the word after it, for one kind. Base values are seeds of score 1. In each
    round, patterns are induced from the seeds: those that hold `least_seeds` distinct ones. A pattern's confidence is the
    sum of their scores over the number of all distinct fillers of its place: base values of any kind, candidates, and
    plain words. Patterns below `least_share` are left. A candidate scores 1 - the product of (1 - confidence) over its
    patterns; from `least_confidence` on it is an identifier of that kind, and a seed of the next round with its score,
    which may induce further patterns. It ends after `rounds`, or when a round finds nothing new.
    """
    edges = stored(_edges(spans), "pii-edges")
    seeds = edges.filter("kind is not null").select("kind", "value").distinct().withColumn("score", F.lit(1.0))
    values, plain = seeds.limit(0), None
    for k in range(rounds):
        held = edges.select("side", "context", "value", F.col("kind").alias("base"), "of").distinct().join(seeds, "value").filter("base = kind or (base is null and (of is null or of = kind))")
        held = held.select("kind", "side", "context", "value", "score").distinct()
        support = held.groupBy("kind", "side", "context").agg(F.sum("score").alias("mass"), F.count("*").alias("seeds")).filter(F.col("seeds") >= least_seeds)
        support = stored(support, f"pii-support-{k}")
        own = edges.join(support.select("side", "context").distinct(), ["side", "context"])
        fillers = own.select("side", "context", "value").distinct().groupBy("side", "context").agg(F.count("*").alias("fillers"))
        patterns = stored(support.join(fillers, ["side", "context"]).filter(F.col("mass") >= least_share * F.col("fillers")), f"pii-patterns-{k}")
        if patterns.isEmpty():
            break
        # plain words are counted once for a context, whatever rounds it is looked at in
        contexts = patterns.select("side", "context").distinct()
        contexts = stored(contexts if plain is None else contexts.join(plain, ["side", "context"], "left_anti"), f"pii-contexts-{k}")
        if not contexts.isEmpty():
            known = own.select("side", "context", "word").distinct()
            words = _words_around(docs, contexts, text_col).join(known, ["side", "context", "word"], "left_anti")
            counted = contexts.join(words.groupBy("side", "context").agg(F.count("*").alias("plain")), ["side", "context"], "left").fillna(0, ["plain"])
            plain = stored(counted if plain is None else plain.unionByName(counted), f"pii-plain-{k}")
        reliable = patterns.join(plain, ["side", "context"]).withColumn("confidence", F.col("mass") / (F.col("fillers") + F.col("plain")))
        reliable = stored(reliable.filter(F.col("confidence") >= least_share), f"pii-reliable-{k}")
        if reliable.isEmpty():
            break
        found = edges.filter("kind is null").drop("kind").join(reliable.select("kind", "side", "context", "confidence"), ["side", "context"]).filter("of is null or of = kind")
        found = found.select("kind", "value", "side", "context", "confidence").distinct()
        # the product is taken as a sum of logarithms, over rounded terms, so that the order doesn't matter
        term = F.round(F.log1p(-F.least(F.col("confidence"), F.lit(1 - 1e-12))), 12).cast("decimal(30,12)")
        scores = found.groupBy("kind", "value").agg((1 - F.exp(F.sum(term).cast("double"))).alias("score"))
        # a value of several kinds is one of that where it scores best
        scores = scores.filter(F.col("score") >= least_confidence).groupBy("value").agg(F.max_by(F.struct("kind", "score"), F.struct("score", "kind")).alias("x")).select("x.kind", "value", "x.score")
        fresh = stored(scores.join(values.select("value"), "value", "left_anti").select("kind", "value", "score"), f"pii-fresh-{k}")
        if fresh.isEmpty():
            break
        values = stored(values.unionByName(fresh), f"pii-values-{k}")
        seeds = stored(seeds.unionByName(fresh.join(seeds, ["kind", "value"], "left_anti").select("kind", "value", "score")), f"pii-seeds-{k}")
    return values


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"


def with_spans(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    least_seeds: int = 5,
    least_confidence: float = 0.8,
    least_share: float = 0.5,
    keep_rows: bool = False,
) -> DataFrame:
    """Find personal data in every whole text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added ones, by start, then
    kind), n_added, and `all_spans` as an array, with the whole row as `row_` if `keep_rows`.

    Base spans are those of PATTERNS that pass KEEP. Candidates are words with a digit of LEAST_LENGTH characters at
    least, and FORMS that pass KEEP_FORM, where no base span is. discovered() tells which are identifiers of a kind; of
    those that lie in each other, the longest is added under its kind. A null or empty text has no spans and the digest of the empty
    list. Repeated rows and null ids are kept as they are. An empty table gives an empty result. Other columns are ignored.
    """
    found = stored(base_spans(docs, id_col=id_col, text_col=text_col, keep_rows=keep_rows), "pii-spans")
    values = stored(discovered(found, docs, rounds=rounds, least_seeds=least_seeds, least_confidence=least_confidence, least_share=least_share, text_col=text_col), "pii-values")
    hits = found.select("row_number_", F.explode("candidates").alias("s")).withColumn("value", F.lower("s.value")).join(values, "value").filter("s.of is null or s.of = kind")
    added = hits.groupBy("row_number_").agg(F.collect_set(F.struct(F.col("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))).alias("added"))
    added = added.withColumn("added", F.expr("filter(added, x -> not exists(added, y -> y.start <= x.start and y.end >= x.end and y.end - y.start > x.end - x.start))"))
    rows = found.join(added, "row_number_", "left")
    base = "concat(" + ", ".join(f"transform({k}, x -> named_struct('start', x.start, 'place', {i}, 'end', x.end, 'kind', '{k}'))" for i, k in enumerate(KINDS)) + ")"
    more = f"transform(coalesce(added, array()), x -> named_struct('start', x.start, 'place', array_position(array({', '.join(map(repr, KINDS))}), x.kind) - 1, 'end', x.end, 'kind', x.kind))"
    span = "array<struct<start:int,place:int,end:int,kind:string>>"
    rows = rows.withColumn("base", F.expr(f"array_sort(cast({base} as {span}))"))
    rows = rows.withColumn("all_spans", F.expr(f"case when added is null then base else array_sort(concat(base, cast({more} as {span}))) end"))
    return rows.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.expr(_joined("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(_joined("all_spans")).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"),
        "all_spans",
        *["row_"] * keep_rows,
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; spans that overlap become one, under the first's kind."""
    merged = F.aggregate(
        spans,
        F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)"),
        lambda t, x: F.when(
            (F.size(t) > 0) & (x["start"] < F.element_at(t, -1)["end"]),
            F.concat(
                F.slice(t, 1, F.size(t) - 1),
                F.array(F.struct(F.element_at(t, -1)["start"].alias("start"), F.greatest(F.element_at(t, -1)["end"], x["end"]).alias("end"), F.element_at(t, -1)["kind"].alias("kind"))),
            ),
        ).otherwise(F.array_append(t, F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))),
    )
    def cut(own: Column) -> Column:
        before = lambda i: F.when(i == 0, 0).otherwise(F.get(own, i - 1)["end"])
        parts = F.transform(own, lambda x, i: F.concat(F.substring(text, before(i) + 1, x["start"] - before(i)), F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(own, -1)["end"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.transform(F.array(merged), cut)[0]).otherwise(text)


def without_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """All rows and columns, with personal data in the text redacted; `length_col` becomes the length of the new text.

    Nulls, repeated rows and empty tables: see with_spans(); a null text stays null.
    """
    rows = with_spans(docs, id_col=id_col, text_col=text_col, keep_rows=True, **options)
    own = lambda c: F.col("row_").getField(c)
    text = redacted(own(text_col), F.col("all_spans"))
    new = {text_col: text} | ({length_col: F.length(text).cast(docs.schema[length_col].dataType)} if length_col else {})
    return rows.select(*((new[c] if c in new else own(c)).alias(c) for c in docs.columns))
