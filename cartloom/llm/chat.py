"""Chat formatting by schema fingerprints (operator 2); DataFrame expressions only.

A record's layout is known by the fingerprint of its nested field paths: ``fingerprint`` hashes their sorted names
(types of values don't count). ``LAYOUTS`` maps fingerprints to declarative mappings, SQL expressions that give
the canonical turns ``array<struct<role, text>>`` or, for tables with a row per turn, the columns to gather.

* ``canonical(df, id)`` takes a table; its layout is found once from the schema. Columns that no layout uses are ignored.
* ``canonical_json(df, id, json)`` takes one JSON value per row; each row's layout is found from its own field paths.

The template writes ``<|turn|>role\\ntext<|end|>\\n`` per turn. Inside roles and texts a backslash becomes
``\\b`` and ``<`` becomes ``\\l`` (in roles also a line feed becomes ``\\n``), so no text can hold a control string
and reading back is exact. The loss mask is the list of (start, length) in code points of the assistant texts.

Defined cases: null roles and texts are empty; rows of a conversation go by turn, role and text, null turns first, and
repeated rows stay; a null conversation id is a conversation of its own; JSON that can't be parsed or has
an unknown layout keeps its row with null turns. An empty table gives no rows.
A conversation is one record of the result, so its turns meet in one task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import table

TURN, END = "<|turn|>", "<|end|>\n"
TURNS_TYPE = "array<struct<role:string,text:string>>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _turn(role: str, field: str) -> str:
    return f"named_struct('role', '{role}', 'text', cast({field} as string))"


def _pairs(*turns: tuple[str, str], optional: tuple[str, ...] = ()) -> str:
    """Turns out of single fields; an optional one counts only if it isn't empty."""
    parts = [f"if(coalesce(cast({field} as string), '') = '', array(), array({_turn(role, field)}))" if field in optional
             else f"array({_turn(role, field)})" for role, field in turns]
    return f"concat({', '.join(parts)})"


def _list(field: str, role: str, text: str, rename: bool = False) -> str:
    names = ", ".join(f"'{x}'" for pair in ROLES.items() for x in pair)
    name = f"coalesce(try_element_at(map({names}), coalesce(m.{role}, '')), m.{role})" if rename else f"m.{role}"
    return f"transform({field}, m -> named_struct('role', {name}, 'text', m.{text}))"


#: Field paths of a layout, and the mapping to turns; "rows" stands for a table with a row for each turn.
MAPPINGS: list[tuple[tuple[str, ...], str]] = [
    (("turn", "role", "text"), "rows"),
    (("turn", "role", "content"), "rows"),
    (("messages[].role", "messages[].content"), _list("messages", "role", "content")),
    (("messages[].role", "messages[].text"), _list("messages", "role", "text")),
    (("conversations[].from", "conversations[].value"), _list("conversations", "`from`", "value", rename=True)),
    (("dialogue[].speaker", "dialogue[].text"), _list("dialogue", "speaker", "text", rename=True)),
    (("prompt", "completion"), _pairs(("user", "prompt"), ("assistant", "completion"))),
    (("prompt", "response"), _pairs(("user", "prompt"), ("assistant", "response"))),
    (("system", "prompt", "response"), _pairs(("system", "system"), ("user", "prompt"), ("assistant", "response"), optional=("system",))),
    (("question", "answer"), _pairs(("user", "question"), ("assistant", "answer"))),
    (("instruction", "output"), _pairs(("user", "instruction"), ("assistant", "output"))),
    (("instruction", "response"), _pairs(("user", "instruction"), ("assistant", "response"))),
    (("instruction", "input", "output"),
     f"array({_turn('user', 'concat(instruction, if(coalesce(input, chr(0)) in (chr(0), space(0)), space(0), concat(chr(10), input)))')}, {_turn('assistant', 'output')})"),
]


def fingerprint(paths: tuple[str, ...] | list[str] | set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


LAYOUTS = {fingerprint(paths): (paths, mapping) for paths, mapping in MAPPINGS}
KNOWN_PATHS = {path for paths, _ in MAPPINGS for path in paths}


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Names of the leaves, as ``a.b`` and ``a[].b``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def _clean(turns: Column) -> Column:
    """Null roles and texts become empty."""
    return F.transform(turns, lambda t: F.struct(
        F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))


def canonical(df: DataFrame, id_column: str) -> DataFrame:
    """(id, turns) of a table in any known layout; columns that no layout uses are ignored."""
    used = [p for p in field_paths(df.schema) if p in KNOWN_PATHS and p != id_column]
    paths, mapping = LAYOUTS.get(fingerprint(used), (None, None))
    if mapping is None:
        raise ValueError(f"no layout has the field paths {sorted(used)}")
    if mapping != "rows":
        return df.select(F.col(id_column), _clean(F.expr(mapping)).alias("turns"))
    rows = F.struct(*[F.col(p) if p == "turn" else F.coalesce(p, F.lit("")).alias(p) for p in paths])
    gathered = df.groupBy(id_column).agg(F.sort_array(F.collect_list(rows)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t[paths[2]].alias("text")))
    return gathered.select(F.col(id_column), _clean(plain).alias("turns"))


def _variant_paths(paths: tuple[str, ...]) -> str:
    """The form in which ``schema_of_variant`` names these paths, without types of leaves."""
    tree: dict = {}
    for path in paths:
        head, _, leaf = path.partition("[].")
        if leaf:
            tree.setdefault(head, {})[leaf] = "_"
        else:
            tree[head] = "_"
    inner = {k: v if v == "_" else "ARRAY<OBJECT<" + ", ".join(f"{n}: _" for n in sorted(v)) + ">>" for k, v in tree.items()}
    return "OBJECT<" + ", ".join(f"{k}: {inner[k]}" for k in sorted(inner)) + ">"


def canonical_json(df: DataFrame, id_column: str, json: str) -> DataFrame:
    """(id, layout, turns) of one JSON value per row; the layout of each row is the fingerprint of its own field paths."""
    value = F.try_parse_json(F.col(json))
    shape = F.regexp_replace(F.schema_of_variant(value), r"\b(STRING|VOID|BIGINT|BOOLEAN|DOUBLE|DECIMAL\(\d+,\s*\d+\))(?=[,>])", "_")
    marked = df.select(F.col(id_column), value.alias("value"), F.sha2(F.regexp_replace(shape, "`", ""), 256).alias("layout"))
    turns = F.lit(None).cast(TURNS_TYPE)
    for paths, mapping in MAPPINGS:
        if mapping == "rows":
            continue
        mine = hashlib.sha256(_variant_paths(paths).encode()).hexdigest()
        fields = {p.partition("[].")[0] for p in paths}
        expression = mapping
        for field in fields:
            leaves = [p.partition("[].")[2] for p in paths if p.startswith(f"{field}[].")]
            kind = f"array<struct<{','.join(f'`{x}`:string' for x in leaves)}>>" if leaves else "string"
            got = f"try_variant_get(value, '$.{field}', '{kind}')"
            expression = expression.replace(f"transform({field},", f"transform({got},") if leaves else _replace_name(expression, field, got)
        turns = F.when(F.col("layout") == mine, F.expr(expression)).otherwise(turns)
    known = F.col("layout").isin([hashlib.sha256(_variant_paths(p).encode()).hexdigest() for p, m in MAPPINGS if m != "rows"])
    return marked.select(F.col(id_column), F.when(known, F.col("layout")).alias("layout"), _clean(turns).alias("turns"))


def _replace_name(expression: str, name: str, by: str) -> str:
    import re

    return re.sub(rf"(?<![\w'.$]){name}(?![\w'(])", by, expression)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def render(turns: DataFrame, id_column: str) -> DataFrame:
    """(id, formatted, loss_mask) of canonical turns."""
    pieces = turns.select(F.col(id_column), F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(TURN), _escape_role(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("learn"))).alias("pieces"))
    sized = pieces.select(F.col(id_column), "pieces", F.transform("pieces", _piece_length).alias("lengths"))
    placed = sized.select(F.col(id_column), "pieces", _running(F.col("lengths")).alias("ends"))
    spans = F.zip_with("pieces", "ends", lambda p, end: F.struct(
        (end - len(END) - F.length(p["body"])).alias("start"),
        F.length(p["body"]).cast("long").alias("length"), p["learn"].alias("learn")))
    return placed.select(
        F.col(id_column),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["learn"]), lambda s: F.struct(s["start"], s["length"])).alias("loss_mask"))


def _piece_length(piece: Column) -> Column:
    return (F.length(piece["head"]) + F.length(piece["body"]) + len(END)).cast("long")


def _running(numbers: Column) -> Column:
    """Running sums of an array, by sums that reach twice as far in each step.

    An array that grows turn by turn would be copied at every turn; this makes log2(turns) copies. Lambdas here and below
    name no column: the optimizer would put that column's whole expression in its place, to be computed for each element.
    """
    powers = F.array(*[F.lit(1 << k) for k in range(31)])
    reaches = F.slice(powers, F.lit(1), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int"))

    def reach_on(sums: Column, reach: Column) -> Column:
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - reach), F.lit(0)))

    return F.aggregate(reaches, numbers, reach_on)


def parse(formatted: DataFrame, id_column: str) -> DataFrame:
    """(id, formatted, turns, loss) read back from (id, formatted, loss_mask): the turns, and the masked texts one by one.

    Spans and bodies are sorted together by their places, so each span stands behind the body that holds it.
    """
    cut = F.array_remove(F.split("formatted", TURN.replace("|", "\\|"), -1), "")  # before the first mark is nothing
    pieces = formatted.select(F.col(id_column), "formatted", "loss_mask", cut.alias("pieces"))
    lengths = F.transform("pieces", lambda p: (F.length(p) + len(TURN)).cast("long"))
    placed = pieces.select("*", lengths.alias("lengths")).select("*", _running(F.col("lengths")).alias("ends"))

    def read_piece(piece: Column, end: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(head) + 2, F.length(piece) - F.length(head) - 1 - len(END))
        start = end - len(END) - F.length(body)
        return F.struct(head.alias("role"), body.alias("body"), start.alias("start"))

    read = placed.select(F.col(id_column), "formatted", "loss_mask", F.zip_with("pieces", "ends", read_piece).alias("read"))
    none = F.lit(None)
    bodies = F.transform("read", lambda p: F.struct(
        p["start"].alias("start"), F.lit(False).alias("is_span"), none.cast("long").alias("length"), p["body"].alias("body")))
    spans = F.transform("loss_mask", lambda s: F.struct(
        s["start"].alias("start"), F.lit(True).alias("is_span"), s["length"].alias("length"), none.cast("string").alias("body")))
    sorted_ = read.select(F.col(id_column), "formatted", "read", F.sort_array(F.concat(bodies, spans)).alias("places"))

    before = F.slice(F.concat(F.array(none), F.col("places")), F.lit(1), F.size("places"))

    def spoken(place: Column, holder: Column) -> Column:
        first = (place["start"] - holder["start"] + 1).cast("int")
        return F.when(place["is_span"], unescape(F.substring(holder["body"], first, place["length"].cast("int"))))

    return sorted_.select(
        F.col(id_column), "formatted",
        F.transform("read", lambda p: F.struct(_unescape_role(p["role"]).alias("role"), unescape(p["body"]).alias("text"))).alias("turns"),
        F.array_compact(F.zip_with("places", before, spoken)).alias("loss"))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    probe = spark.sql(r"SELECT -7L AS conv_id, r'\### Assistant: </turn> ok' AS instruction, r'\### Assistant: </turn> ok' AS output")
    turns = canonical(table(spark, folder, "conversations"), "conv_id").union(canonical(probe, "conv_id"))
    read = parse(render(turns, "conv_id"), "conv_id")
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP2_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 1, 'user', '\### Assistant: </turn> ok'), (-7, 2, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + length(role) + length(text) + length(regexp_replace(role, '[^\\<\n]', '', 'g'))
    + length(regexp_replace(text, '[^\\<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

QUERIES = {"op2_chat_format": (op2_chat_format, OP2_SQL)}
