"""Chat formatting with typed content parts, in DataFrame expressions alone.

A message holds parts: text, or an image, audio or document attachment. A visitor renders each part in order: text escaped,
attachments as placeholders, with the reference recorded and the tokens counted that the placeholder expands to. Turns are
marked by control strings. Every control string begins with `<|`, and inside texts `<|` cannot occur: a backslash goes
between the two, one more where backslashes stand there already, which can be taken back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "<|text|>"  # before a text part that is not the first part
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens an attachment expands to: an image by patches of 28 x 28 pixels, audio by second, a document by page.
IMAGE_PATCH, AUDIO_TOKENS_PER_SECOND, DOCUMENT_TOKENS_PER_PAGE = 28, 25, 800

PART_TYPE = "struct<type string, text string, ref string, width int, height int, seconds double, pages int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """The parts of a message that is a text."""
    null = F.lit(None)
    values = [F.lit("text"), F.coalesce(text.cast("string"), F.lit("")), null, null, null, null, null]
    names = ["type", "text", "ref", "width", "height", "seconds", "pages"]
    kinds = ["string", "string", "string", "int", "int", "double", "int"]
    return F.array(F.struct(*[v.cast(k).alias(n) for v, k, n in zip(values, kinds, names)]))


def _visit(parts: str = "parts") -> Column:
    """Per part: what is rendered, the length of the mark before it, its kind, reference and expanded tokens."""
    kinds = ", ".join(f"'{k}'" for k in PLACEHOLDERS)
    marks = " ".join(f"when '{k}' then '{m}'" for k, m in PLACEHOLDERS.items())
    escaped = r"regexp_replace(coalesce(p.text, ''), '<(\\\\*)\\|', '<$1\\\\|')"
    return F.expr(
        f"""transform(filter({parts}, p -> p is not null), (p, i) -> named_struct(
        'kind', if(p.type in ({kinds}), p.type, 'text'),
        'mark', if(p.type in ({kinds}), '', if(i > 0, '{PART}', '')),
        'said', case p.type {marks} else {escaped} end,
        'ref', if(p.type in ({kinds}), p.ref, null),
        'tokens', case p.type
            when 'image' then cast(ceil(coalesce(p.width, 0) / {IMAGE_PATCH}) * ceil(coalesce(p.height, 0) / {IMAGE_PATCH}) as long)
            when 'audio' then cast(ceil(coalesce(p.seconds, 0) * {AUDIO_TOKENS_PER_SECOND}) as long)
            when 'document' then cast(coalesce(p.pages, 0) * {DOCUMENT_TOKENS_PER_PAGE} as long)
            else 0L end))"""
    )


def format_conversations(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation of messages (conv_id, turn, role, and parts or else text): conv_id, formatted, loss, attachments, expanded_tokens.

    `loss` are the spans (turn index, start, end; code points, end exclusive) of the text parts of the trained role;
    `attachments` (turn index, part index, kind, ref, tokens) are in order of their placeholders. Messages are ordered by turn, then role,
    then content, nulls first; repeated rows are repeated turns. A null text or role is empty, a message without parts has no
    text, parts of unknown type are text. Null ids form one conversation. An empty table gives no rows; further columns are
    left out. A conversation is one value, since its text is; all its turns meet in one task.
    """
    parts = F.col("parts").cast(f"array<{PART_TYPE}>") if "parts" in messages.columns else text_part(F.col("text"))
    rows = messages.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>")).alias("parts"))
    rows = rows.select("conv_id", "turn", "role", _visit().alias("visited"))
    body = F.expr("array_join(transform(visited, v -> concat(v.mark, v.said)), '')")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = rows.select("conv_id", "turn", "role", "visited", F.length(head).alias("lead"), F.concat(head, body, F.lit(END + "\n")).alias("said"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    before = F.sum(F.length("said").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("said")
    rows = rows.withColumn("index", F.row_number().over(order) - 1).withColumn("at", before + F.col("lead"))
    # Places of the parts of one message, by adding up the lengths before them.
    placed = F.expr(
        """transform(visited, (v, i) -> named_struct('index', index, 'part', i, 'kind', v.kind, 'ref', v.ref, 'tokens', v.tokens,
        'start', at + aggregate(slice(visited, 1, i), 0L, (n, x) -> n + length(x.mark) + length(x.said)) + length(v.mark), 'size', length(v.said)))"""
    )
    rows = rows.withColumn("placed", placed).withColumn("trained", F.col("role") == trained_role)
    spans = "transform(filter(placed, p -> trained and p.kind = 'text'), p -> named_struct('index', p.index, 'start', p.start, 'end', p.start + p.size))"
    files = "transform(filter(placed, p -> p.kind <> 'text'), p -> named_struct('index', p.index, 'part', p.part, 'kind', p.kind, 'ref', p.ref, 'tokens', p.tokens))"
    turn = F.struct("index", "said", F.expr(spans).alias("loss"), F.expr(files).alias("attachments"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id",
        F.expr("array_join(transform(turns, t -> t.said), '')").alias("formatted"),
        F.flatten("turns.loss").alias("loss"),
        F.flatten("turns.attachments").alias("attachments"),
        F.expr("aggregate(flatten(turns.attachments), 0L, (n, a) -> n + a.tokens)").alias("expanded_tokens"),
    )


def read_turns(formatted: str = "formatted") -> Column:
    """The turns of a formatted conversation, read back: chunk (from its start mark), role and body, still escaped."""
    start, end = r"<\\|im_start\\|>", END
    return F.expr(
        f"""transform(filter(split({formatted}, '{start}'), (c, i) -> i > 0), c -> named_struct(
        'chunk', c, 'role', substring_index(c, '\n', 1),
        'body', substring(c, cast(length(substring_index(c, '\n', 1)) + 2 as int),
            cast(length(c) - length(substring_index(c, '\n', 1)) - 1 - {len(end) + 1} as int))))"""
    )


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and n_attachments, all read back from the formatted text and its loss spans."""
    undo = r"regexp_replace({}, '<\\\\(\\\\*)\\|', '<$1|')"
    role = "replace(replace(replace({}, '%3C', '<'), '%0A', '\n'), '%25', '%')"
    rows = conversations.withColumn("turns", read_turns())
    rows = rows.withColumn(
        "read", F.expr(f"array_join(transform(turns, t -> concat({role.format('t.role')}, '\n', {undo.format('t.body')}, '\n')), '')")
    )
    # Spans are cut from their own turn's chunk, so that a long conversation is not walked through for each.
    span = "substring(turns[s.index].chunk, cast(s.start - starts[s.index] + 1 as int), cast(s.end - s.start as int))"
    masked = f"array_join(transform(loss, s -> {undo.format(span)}), '')"
    each = rows.withColumn("starts", F.expr(_CHUNK_STARTS))
    each = each.withColumn("masked", F.expr(masked))
    return each.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("read", 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
    )


# Where each turn's chunk begins in the formatted text: a running sum of the chunks before it and their start marks.
_CHUNK_STARTS = f"""aggregate(turns, named_struct('at', cast({len(START)} as long), 'all', cast(array() as array<long>)),
    (x, t) -> named_struct('at', x.at + length(t.chunk) + {len(START)}, 'all', array_append(x.all, x.at)), x -> x.all)"""
