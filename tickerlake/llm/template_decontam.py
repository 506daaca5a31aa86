r"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Runs of capitalised words inside a sentence (names), numbers, and units after numbers become typed placeholders; the rest is lower-cased words. Windows
of ``WINDOW`` tokens of the benchmark items (a shorter item is one window of its own length, three tokens at least) are hash-joined with all
windows of all texts. At least half of a window's tokens have to be words. Each hit is then checked on the tokens themselves, with
slots numbered by first appearance: equal values in the item must be equal in the text, and different ones different. This finds copies and
re-parameterised questions alike.

A pair (doc_id, item_id) counts when the text holds ``RUN`` of the item's windows (13 tokens in a row with the defaults) or half of them, whichever is less.

Templates miss verbatim copies of some items: of few words, of one window only, or with capitalised words that are names or not by what stands
before them or by a line break. For these items, windows of plain lower-cased tokens are joined as well (of ``WINDOW`` tokens, or the whole
shorter item, were it one token; letters of scripts without spaces are tokens of their own), and a pair that only these find counts by the same rule.

Items with fewer than ``EVIDENCE`` letters and digits (letters of scripts without spaces count twice) say nothing: "Why?" stands in any text. They make no pair;
``undecidable`` lists them.

Results for odd rows: NULL and empty texts and items have no windows. Very long texts count whole, also long runs of capitalised words or number groups: no pattern recurses, and a
text's hits grow with its length only, whatever repeats. Repeated rows of a doc_id or item_id count as one text or item with the windows of all, equal rows
as one. A row without doc_id cannot be named in a pair; ``decontaminated`` judges it all the same. Ties do not arise. An empty table on either side gives no pair and takes
no row away. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import identified, table, text_print, texts
from tickerlake.session import materialise

WINDOW = 8
LEAST_TOKENS = 3
RUN = 6
EVIDENCE = 12

#: Placeholders, one for each type: private-use characters, which are taken out of the texts first.
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
SLOTS = NAME + NUMBER + UNIT
# Possessive: nothing follows a repetition that it could give back, and Java repeats a group without recursion only so.
NAME_PATTERN = r"([\p{Ll},;])((?: \p{Lu}\p{L}++)++)"
NUMBER_PATTERN = r"\p{Nd}++(?:[.,:/]\p{Nd}++)*+"
UNITS = (
    "km m cm mm mi mile miles ft feet foot inch inches yard yards kg g mg lb lbs oz pound pounds gram grams kilogram kilograms ton tons "
    "l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "mph kmh kph degree degrees dollar dollars cent cents euro euros percent usd eur gbp kb mb gb tb hz khz mhz ghz w kw mw v volt volts"
).split()
UNIT_PATTERN = rf" {NUMBER} [ -]?(%|{'|'.join(sorted(UNITS, key=lambda u: (-len(u), u)))})([^\p{{L}}\p{{N}}]|$)"
TOKEN_PATTERN = r"[\p{L}\p{N}\x{E000}-\x{E002}]+"

#: Letters that follow each other without spaces, and the plain tokens.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
PLAIN_PATTERN = rf"[{UNSPACED}&&[\p{{L}}\p{{N}}]]|[\p{{L}}\p{{N}}&&[^{UNSPACED}]]+"
#: Capitalised words that a copy's surroundings or white space may make names or not: inside a sentence, or two and more at the item's start.
UNSURE_PATTERN = r"[\p{Ll},;]\s+\p{Lu}\p{L}+|^[^\p{L}]*\p{Lu}\p{L}+\s+\p{Lu}\p{L}+"


def _clean(text: Column) -> Column:
    return F.translate(text, SLOTS, "")


def _named(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, NAME_PATTERN, f"$1 {NAME} "))


def _counted(named: Column) -> Column:
    return F.regexp_replace(named, NUMBER_PATTERN, f" {NUMBER} ")


def _tokens(counted: Column) -> Column:
    united = F.regexp_replace(counted, UNIT_PATTERN, f" {NUMBER} {UNIT} $2")
    return F.regexp_extract_all(united, F.lit(TOKEN_PATTERN), F.lit(0))


def template_tokens(text: Column) -> Column:
    """Lower-case words and placeholders of a text."""
    return _tokens(_counted(_named(_clean(text))))


def _slotted(df: DataFrame) -> DataFrame:
    """Adds tokens, and the places and values of its placeholders."""
    df = df.withColumn("clean", _clean(F.col("text"))).withColumn("named", _named(F.col("clean"))).withColumn("counted", _counted(F.col("named")))
    df = df.withColumn("tokens", _tokens(F.col("counted")))

    def places(slot: str) -> Column:
        return F.filter(F.transform("tokens", lambda t, i: F.when(t == slot, i)), lambda i: i.isNotNull())

    values = [
        F.regexp_extract_all("clean", F.lit(NAME_PATTERN), F.lit(2)),
        F.regexp_extract_all("named", F.lit(NUMBER_PATTERN), F.lit(0)),
        F.regexp_extract_all("counted", F.lit(UNIT_PATTERN), F.lit(1)),
    ]
    df = df.withColumn("places", F.concat(*[places(s) for s in SLOTS])).withColumn("values", F.concat(*values))
    return df.drop("text", "clean", "named", "counted")


def _is_slot(token: Column) -> Column:
    return token.isin(*SLOTS)


def _window_hashes(hashes: str, sizes: list[int], salt: int = 0) -> Column:
    """(at, size, key) of the windows of all sizes, from one array of token hashes."""

    def of(size: int) -> Column:
        def one(i: Column) -> Column:
            key = F.xxhash64(F.lit(salt + size), *[F.get(hashes, i + k) for k in range(size)])
            return F.struct(i.alias("at"), F.lit(size).alias("size"), key.alias("key"))

        return F.when(F.size(hashes) >= size, F.transform(F.sequence(F.lit(0), F.size(hashes) - size), one)).otherwise(F.array())

    return F.flatten(F.array(*[of(n) for n in sizes])) if len(sizes) > 1 else of(sizes[0])


def _hashes(tokens: str) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def evidence(text: Column) -> Column:
    """Letters and digits of a text, those of scripts without spaces twice."""
    held = F.regexp_replace(text, r"[^\p{L}\p{N}]", "")
    return F.length(held) + F.length(F.regexp_replace(held, f"[^{UNSPACED}]", ""))


def undecidable(benchmark: DataFrame) -> DataFrame:
    """item_id and text of the items that hold too little to be recognised by."""
    return benchmark.select("item_id", "text").where(F.coalesce(evidence(F.col("text").cast("string")), F.lit(0)) < EVIDENCE)


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, size, place, key of the items' windows that are mostly words."""
    tokens = items.select(F.col("doc_id").alias("item_id"), template_tokens(F.col("text")).alias("tokens"))
    tokens = tokens.withColumn("size", F.least(F.size("tokens"), F.lit(WINDOW))).where(F.col("size") >= LEAST_TOKENS)
    tokens = tokens.withColumn("hashes", _hashes("tokens"))
    placed = tokens.select("item_id", "tokens", F.explode(_window_hashes("hashes", list(range(LEAST_TOKENS, WINDOW + 1)))).alias("w"), F.col("size").alias("own"))
    placed = placed.where(F.col("w.size") == F.col("own")).select("item_id", F.col("w.size").alias("size"), F.col("w.at").alias("place"), F.col("w.key").alias("key"), "tokens")
    window = placed.withColumn("window", F.slice("tokens", F.col("place") + 1, F.col("size")))
    return window.where(2 * F.size(F.filter("window", lambda t: ~_is_slot(t))) >= F.col("size")).select("item_id", "size", "place", "key")


def plain_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(_clean(text)), F.lit(PLAIN_PATTERN), F.lit(0))


def plain_item_windows(items: DataFrame) -> DataFrame:
    """item_id, size, place, key, other of the items that templates may miss in a verbatim copy; key and other are 128 bits of the window."""
    judged = items.select(F.col("doc_id").alias("item_id"), "text", template_tokens(F.col("text")).alias("tokens"))
    size = F.least(F.size("tokens"), F.lit(WINDOW))
    wordless = F.exists(F.sequence(F.lit(0), F.size("tokens") - size), lambda p: 2 * F.size(F.filter(F.slice("tokens", p + 1, size), lambda t: ~_is_slot(t))) < size)
    unsure = judged.where((F.size("tokens") <= WINDOW) | wordless | F.col("text").rlike(UNSURE_PATTERN))
    plain = unsure.select("item_id", plain_tokens(F.col("text")).alias("plain")).where(F.size("plain") > 0)
    plain = plain.withColumn("own", F.least(F.size("plain"), F.lit(WINDOW)))
    return _plain_rows(plain, ["item_id", "own"], list(range(1, WINDOW + 1))).where(F.col("size") == F.col("own")).withColumnRenamed("at", "place").drop("own")


def _plain_rows(plain: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """at, size, key, other of the plain windows of the given sizes, from one pass over the tokens."""
    hashed = plain.select(*keep, _hashes("plain").alias("hashes"), F.transform("plain", lambda t: F.xxhash64(F.lit("other"), t)).alias("others"))
    both = F.arrays_zip(_window_hashes("hashes", sizes).alias("a"), _window_hashes("others", sizes, 100).alias("b"))
    rows = hashed.select(*keep, F.explode(both).alias("w"))
    return rows.select(*keep, F.col("w.a.at").alias("at"), F.col("w.a.size").alias("size"), F.col("w.a.key").alias("key"), F.col("w.b.key").alias("other"))


def verbatim(given: DataFrame, items: DataFrame, run: int) -> DataFrame | None:
    """The pairs that plain windows find, as those of ``contaminated``; None if templates do for all items."""
    windows = materialise(plain_item_windows(items), "plain-item-windows")
    # At most WINDOW numbers come to the driver.
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    if not sizes:
        return None
    each = _plain_rows(given.select("doc_id", plain_tokens(F.col("text")).alias("plain")), ["doc_id"], sizes)
    found = each.select("doc_id", "key", "other").join(windows, ["key", "other"]).select("doc_id", "item_id", "place", "size")
    counts = found.groupBy("doc_id", "item_id").agg(F.countDistinct("place", "size").alias("n_windows"))
    totals = windows.groupBy("item_id").agg(F.countDistinct("place", "size").alias("n_item_windows"))
    return _counting(counts.join(totals, "item_id"), run).select("doc_id", "item_id", "n_windows", "n_item_windows", F.lit(True).alias("same_values"))


def _counting(pairs: DataFrame, run: int) -> DataFrame:
    return pairs.where((F.col("n_windows") >= run) | (2 * F.col("n_windows") >= F.col("n_item_windows")))


def _filled(alias: str, place: Column, size: Column) -> Column:
    """The window's tokens, placeholders with their values."""

    def one(k: Column) -> Column:
        token = F.get(f"{alias}.tokens", place + k)
        value = F.get(f"{alias}.values", (F.array_position(F.col(f"{alias}.places"), (place + k).cast("int")) - 1).cast("int"))
        return F.when(_is_slot(token), F.concat(token, value)).otherwise(token)

    return F.transform(F.sequence(F.lit(0), size - 1), one)


def _numbered(window: str) -> Column:
    """The window with every value replaced by the place where it first stands."""

    def one(token: Column) -> Column:
        return F.when(_is_slot(F.substr(token, F.lit(1), F.lit(1))), F.concat(F.substr(token, F.lit(1), F.lit(1)), F.array_position(F.col(window), token).cast("string"))).otherwise(token)

    return F.transform(window, one)


def _filled_windows(hits: DataFrame, given: DataFrame, out: str) -> DataFrame:
    """(doc_id, key, size, out) for hits (doc_id, at, size, key): the different windows of each text, placeholders filled; a text's hits are as many as its windows at most."""
    each = hits.groupBy("doc_id").agg(F.collect_list(F.struct("at", "size", "key")).alias("hits"))
    both = each.alias("h").join(_slotted(given).alias("d"), F.col("h.doc_id") == F.col("d.doc_id"))

    def one(hit: Column) -> Column:
        return F.struct(hit["key"].alias("key"), hit["size"].alias("size"), _filled("d", hit["at"], hit["size"]).alias(out), hit["at"].alias("at"))

    return both.select("h.doc_id", F.inline(F.transform("hits", one)))


def contaminated(docs: DataFrame, benchmark: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, item_id, n_windows (of the item, found in the text), n_item_windows, same_values, for the pairs that count.

    The items' windows are written once, so the join is planned by their true size: a broadcast below Spark's limit, else both sides are
    shuffled by window, where skewed windows are split. A text's hits are kept once per window, not once per item, until the slots are filled and equal windows are one.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.where(F.col("doc_id").isNotNull() & (evidence(F.col("text")) >= EVIDENCE))
    given = texts(docs).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    windows = materialise(item_windows(items), "item-windows")
    # At most WINDOW - LEAST_TOKENS + 1 numbers come to the driver.
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect()) or [WINDOW]
    hashed = given.select("doc_id", F.transform(template_tokens(F.col("text")), lambda t: F.xxhash64(t)).alias("hashes"))
    each = hashed.select("doc_id", F.inline(_window_hashes("hashes", sizes)))
    keys = materialise(windows.select("key").distinct(), "item-window-keys")
    hits = materialise(each.join(keys, "key", "left_semi").select("doc_id", "at", "size", "key"), "template-hits")
    ids = materialise(hits.select("doc_id").distinct(), "template-hit-ids")
    mine = _filled_windows(hits, given.join(ids, "doc_id", "left_semi"), "mine").select("doc_id", "key", "size", "mine").distinct()
    own = windows.select(F.col("item_id").alias("doc_id"), F.col("place").alias("at"), "size", "key")
    theirs = materialise(_filled_windows(own, items, "theirs").select(F.col("doc_id").alias("item_id"), "key", "size", F.col("at").alias("place"), "theirs"), "item-fillings")
    checked = mine.join(theirs, ["key", "size"]).where(_numbered("mine") == _numbered("theirs"))
    counts = checked.groupBy("doc_id", "item_id").agg(
        F.countDistinct("place", "size").alias("n_windows"), F.bool_and(F.col("mine") == F.col("theirs")).alias("same_values")
    )
    totals = windows.groupBy("item_id").agg(F.countDistinct("place", "size").alias("n_item_windows"))
    pairs = _counting(counts.join(totals, "item_id"), run).select("doc_id", "item_id", "n_windows", "n_item_windows", "same_values")
    plain = verbatim(given, items, run)
    if plain is None:
        return pairs
    pairs = materialise(pairs, "template-pairs")
    return pairs.unionByName(plain.join(pairs.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_anti").select(*pairs.columns))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are in no contaminated pair, as they are; those without doc_id are judged by their texts."""
    given, nameless = identified(texts(docs))
    bad = materialise(contaminated(given, benchmark).select(F.col("doc_id").alias("#bad")).distinct(), "contaminated")
    prints = given.where(F.col("doc_id") >= nameless).join(bad, F.col("doc_id") == F.col("#bad"), "left_semi").select(text_print("text").alias("#print")).distinct()
    prints = materialise(prints, "contaminated-texts")
    kept = docs.join(bad, docs["doc_id"] == bad["#bad"], "left_anti")
    return kept.join(prints, F.when(docs["doc_id"].isNull(), text_print(docs["text"].cast("string"))) == prints["#print"], "left_anti")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The same patterns for an engine that never recurses and knows no possessive repetition.
_NAME_SQL, _NUMBER_SQL = NAME_PATTERN.replace("++", "+"), NUMBER_PATTERN.replace("++", "+").replace("*+", "*")
_UNSPACED_SQL = UNSPACED.replace("Is", "")


def _sql_side(table_name: str, key: str, where: str = "") -> str:
    """A table's tokens with the places and values of its placeholders."""
    first, second, third = (f"list_filter(range(len(tokens)), lambda i: tokens[i + 1] = '{s}')" for s in SLOTS)
    return rf"""
      SELECT key, tokens, list_concat(list_concat({first}, {second}), {third}) AS places, vals
      FROM (
        SELECT key, regexp_extract_all(regexp_replace(counted, '{UNIT_PATTERN}', ' {NUMBER} {UNIT} \2', 'g'), '{TOKEN_PATTERN}') AS tokens,
          list_concat(list_concat(regexp_extract_all(clean, '{_NAME_SQL}', 2), regexp_extract_all(named, '{_NUMBER_SQL}')), regexp_extract_all(counted, '{UNIT_PATTERN}', 1)) AS vals
        FROM (
          SELECT *, regexp_replace(named, '{_NUMBER_SQL}', ' {NUMBER} ', 'g') AS counted
          FROM (
            SELECT *, lower(regexp_replace(clean, '{_NAME_SQL}', '\1 {NAME} ', 'g')) AS named
            FROM (SELECT {key} AS key, translate(text, '{SLOTS}', '') AS clean FROM {table_name} WHERE {key} IS NOT NULL AND text IS NOT NULL{where})
          )
        )
      )"""


def _sql_window(side: str) -> str:
    slot = f"list_contains(['{NAME}', '{NUMBER}', '{UNIT}'], {side}.tokens[p + 1])"
    return f"list_transform(range({side}_at, {side}_at + size), lambda p: CASE WHEN {slot} THEN {side}.tokens[p + 1] || {side}.vals[list_position({side}.places, p)] ELSE {side}.tokens[p + 1] END)"


def _sql_numbered(window: str) -> str:
    return f"list_transform({window}, lambda t: CASE WHEN list_contains(['{NAME}', '{NUMBER}', '{UNIT}'], t[1]) THEN t[1] || list_position({window}, t) ELSE t END)"


_HELD_SQL = r"regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')"
_EVIDENCE_SQL = f"(length({_HELD_SQL}) + length(regexp_replace({_HELD_SQL}, '[^{_UNSPACED_SQL}]', '', 'g')))"
_PLAIN_SQL = rf"regexp_extract_all(regexp_replace(lower(translate(text, '{SLOTS}', '')), '([{_UNSPACED_SQL}])', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')"

OP4_SQL = f"""
WITH d AS ({_sql_side("documents", "doc_id")}), b AS ({_sql_side("benchmark", "item_id", f" AND {_EVIDENCE_SQL} >= {EVIDENCE}")}),
item_windows AS (
  SELECT * FROM (
    SELECT item_id, size, b_at, tokens[b_at + 1:b_at + size] AS w
    FROM (SELECT key AS item_id, least(len(tokens), {WINDOW}) AS size, tokens, unnest(range(len(tokens) - least(len(tokens), {WINDOW}) + 1)) AS b_at FROM b WHERE len(tokens) >= {LEAST_TOKENS})
  ) WHERE 2 * len(list_filter(w, lambda t: NOT list_contains(['{NAME}', '{NUMBER}', '{UNIT}'], t))) >= size
), doc_windows AS (
  SELECT key AS doc_id, size, unnest(range(len(tokens) - size + 1)) AS d_at, unnest(list_transform(range(len(tokens) - size + 1), lambda i: tokens[i + 1:i + size])) AS w
  FROM d, (SELECT DISTINCT size FROM item_windows) WHERE len(tokens) >= size
), pairs AS (
  SELECT doc_id, item_id, d_at, b_at, size FROM doc_windows JOIN item_windows USING (size, w)
), hits AS (
  SELECT doc_id, item_id, b_at, size, {_sql_window("d")} AS mine, {_sql_window("b")} AS theirs
  FROM pairs JOIN d ON d.key = doc_id JOIN b ON b.key = item_id
), checked AS (
  SELECT * FROM hits WHERE {_sql_numbered("mine")} = {_sql_numbered("theirs")}
), totals AS (
  SELECT item_id, count(DISTINCT (b_at, size)) AS n_item_windows FROM item_windows GROUP BY item_id
), template_pairs AS (
  SELECT doc_id, item_id, n_windows, n_item_windows, same_values
  FROM (SELECT doc_id, item_id, count(DISTINCT (b_at, size)) AS n_windows, bool_and(mine = theirs) AS same_values FROM checked GROUP BY doc_id, item_id) JOIN totals USING (item_id)
  WHERE n_windows >= {RUN} OR 2 * n_windows >= n_item_windows
), unsure AS (
  SELECT item_id, text FROM benchmark JOIN b ON b.key = item_id
  WHERE text IS NOT NULL AND {_EVIDENCE_SQL} >= {EVIDENCE} AND (len(tokens) <= {WINDOW} OR regexp_matches(text, '{UNSURE_PATTERN}') OR len(list_filter(
    range(len(tokens) - {WINDOW} + 1), lambda p: 2 * len(list_filter(tokens[p + 1:p + {WINDOW}], lambda t: NOT list_contains(['{NAME}', '{NUMBER}', '{UNIT}'], t))) < {WINDOW})) > 0)
), plain_items AS (
  SELECT item_id, size, place, p[place + 1:place + size] AS w
  FROM (SELECT item_id, p, least(len(p), {WINDOW}) AS size, unnest(range(len(p) - least(len(p), {WINDOW}) + 1)) AS place FROM (SELECT DISTINCT item_id, {_PLAIN_SQL} AS p FROM unsure) WHERE len(p) > 0)
), plain_docs AS (
  SELECT DISTINCT doc_id, size, unnest(list_transform(range(len(p) - size + 1), lambda i: p[i + 1:i + size])) AS w
  FROM (SELECT doc_id, {_PLAIN_SQL} AS p FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL), (SELECT DISTINCT size FROM plain_items) WHERE len(p) >= size
), plain_pairs AS (
  SELECT doc_id, item_id, count(DISTINCT (place, size)) AS n_windows, any_value(n) AS n_item_windows
  FROM plain_docs JOIN plain_items USING (size, w) JOIN (SELECT item_id, count(DISTINCT (place, size)) AS n FROM plain_items GROUP BY item_id) USING (item_id) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_windows, n_item_windows, same_values FROM template_pairs
UNION ALL
SELECT doc_id, item_id, n_windows, n_item_windows, true FROM plain_pairs
WHERE (n_windows >= {RUN} OR 2 * n_windows >= n_item_windows) AND (doc_id, item_id) NOT IN (SELECT (doc_id, item_id) FROM template_pairs)
"""
