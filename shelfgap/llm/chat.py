"""Chat formatting in windows of a token budget, with a loss mask.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. A long conversation is cut between turns
into windows; each repeats the system turn and the last turns before it, and only its own
assistant texts are under the loss mask, so every one of them is a target once.

DataFrame functions only. Which window a turn belongs to follows from sums over the turns before
it, added up per chunk of turns, so that positions need no fold over a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfgap.llm.common import staged

BEGIN, END = "<|im_start|>", "<|im_end|>\n"  # fixed values of the template
# A long run counts by its length, whatever it is made of.
_TOKEN = r"\p{L}{1,12}|\p{N}|[^\s\p{L}\p{N}]{1,4}|\s{16}"
_TURN_TOKENS = 4  # of the template itself
BUDGET = 2048
HISTORY = 256
TURN_CHUNK = 1024


def escape(text: Column) -> Column:
    """Text in which no control string can begin."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("\\1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\1"), F.lit("<|")), F.lit("\\0"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\2"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\2"), F.lit("\n")))


def _placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Every turn with its tokens, the tokens before it in its conversation, its window and the
    tokens of the system turn that windows repeat (0 if they repeat none).

    Windows are numbered upwards, not densely. With C tokens left for new turns, beside history and
    the repeated system turn, a turn of more than C/2 tokens has a window of its own; the others share one while their first token lies in
    the same stretch of C/2, which with the last turn makes C at most.
    """
    rows = turns.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / TURN_CHUNK).alias("chunk"),
    )
    tokens = F.regexp_count("text", F.lit(_TOKEN)).cast("long") + _TURN_TOKENS
    rows = rows.withColumn("tokens", tokens)
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    in_chunk = Window.partitionBy("conv_id", "chunk").orderBy(*order)
    rows = rows.withColumn("at", F.row_number().over(in_chunk))

    chunks = rows.groupBy("conv_id", "chunk").agg(
        F.sum("tokens").alias("n"),
        F.count(F.lit(1)).alias("turns"),
        F.min(F.when(F.col("at") == 1, F.struct("role", "tokens"))).alias("head"),
    )
    by_chunk = Window.partitionBy("conv_id").orderBy(F.col("chunk").asc_nulls_first())
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    head = F.first("head").over(by_chunk)
    repeated = (head["role"] == "system") & (head["tokens"] <= (budget - history) // 2)
    system = F.when(repeated, head["tokens"]).otherwise(0)
    chunks = chunks.select(
        F.col("conv_id").alias("of"),
        F.col("chunk").alias("in_chunk"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
        system.alias("system"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & F.col("chunk").eqNullSafe(F.col("in_chunk"))
    rows = rows.join(chunks, same).drop("of", "in_chunk")
    before = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.col("base") + F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    rows = rows.withColumn("pos", F.col("turns_before") + F.col("at") - 1)
    room = F.lit(budget - history) - F.col("system")
    rows = rows.withColumn("half", F.greatest(F.floor(room / 2), F.lit(1))).withColumn("big", F.col("tokens") > F.col("half"))
    # Long turns before this one, again per chunk first.
    big = F.col("big").cast("long")
    counts = rows.groupBy("conv_id", "chunk").agg(F.sum(big).alias("n"))
    counts = counts.select(
        F.col("conv_id").alias("of"),
        F.col("chunk").alias("in_chunk"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("big_base"),
    )
    rows = rows.join(counts, same).drop("of", "in_chunk")
    big_before = F.col("big_base") + F.coalesce(F.sum(big).over(before), F.lit(0))
    edge = 2 * big_before + big
    rows = rows.withColumn("window", edge * F.lit(1 << 40) + F.floor(F.col("start") / F.col("half")))
    return rows.select("conv_id", "pos", "role", "text", "tokens", "start", "window", "system")


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted, n_context, loss and n_tokens of every window.

    ``formatted`` holds the window's turns, of which the first ``n_context`` repeat earlier
    windows: the system turn, if the conversation begins with one, and up to ``history`` tokens of
    turns before.

    A window has more tokens than ``budget`` only if it has a single turn of its own that does not
    fit beside the system turn; it stays uncut and repeats no history. Where a turn leaves less
    room, the window repeats less history. A system turn of more than half of budget less history
    is repeated nowhere; it stands in its own place only. Tokens are counted by a pattern: up to 12
    letters, one digit, up to 4 other signs or 16 blanks each. ``loss`` lists the targets as ``start`` and ``end`` (code points of
    ``formatted``, end excluded). Windows of a conversation follow each other by ``window``.

    ``turns`` has conv_id, turn, role and text. A NULL text or role counts as empty. Rows with the
    same turn are ordered by role and text, NULL turns come first, and the rows of NULL conv_id
    are one conversation. An empty table gives an empty result. Other columns are ignored.
    """
    # Four branches read this; staged, the texts are not shuffled for each of them.
    placed = staged(_placed(turns, budget, history), "turns")
    piece = F.concat(
        F.lit(BEGIN), _escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END)
    )
    placed = placed.withColumn("piece", piece).withColumn(
        "head_chars", F.char_length(_escape_role(F.col("role"))) + len(BEGIN) + 1
    )
    is_system = (F.col("pos") == 0) & (F.col("role") == "system")
    columns = ["conv_id", "window", "pos", "tokens", "piece", "head_chars"]
    own = placed.select(
        *columns, (F.col("role") == "assistant").alias("target"), F.lit(False).alias("context")
    )
    windows = placed.groupBy("conv_id", "window").agg(
        F.min("start").alias("from"),
        F.min("pos").alias("first"),
        F.first("system").alias("system"),
        F.sum("tokens").alias("own"),
    )
    with_system = (F.col("system") > 0) & (F.col("first") > 0)
    left = F.lit(budget) - F.col("own") - F.when(with_system, F.col("system")).otherwise(0)
    windows = windows.select(
        F.col("conv_id").alias("of"),
        F.col("window").alias("into"),
        "from",
        with_system.alias("with_system"),
        F.least(F.lit(history), left).alias("room"),
        F.floor(F.col("from") / history).alias("stretch"),
    )
    # A turn is history of the windows that begin up to ``history`` tokens after its start.
    at = F.floor(F.col("start") / history)
    spread = placed.where(~is_system).withColumn("near", F.explode(F.array(at, at + 1)))
    gap = F.col("from") - F.col("start")
    earlier = spread.join(
        windows,
        F.col("conv_id").eqNullSafe(F.col("of"))
        & (F.col("near") == F.col("stretch"))
        & (gap > 0)
        & (gap <= F.col("room")),
    )
    system = placed.where(is_system).join(
        windows.where("with_system"), F.col("conv_id").eqNullSafe(F.col("of"))
    )
    context = [
        df.select(
            "conv_id", F.col("into").alias("window"), *columns[2:], F.lit(False).alias("target"), F.lit(True).alias("context")
        )
        for df in (earlier, system)
    ]
    entries = own.unionByName(context[0]).unionByName(context[1])
    order = Window.partitionBy("conv_id", "window").orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.col("head_chars")
    end = offset - F.col("head_chars") + F.char_length("piece") - len(END)
    entries = entries.withColumn("span", F.when(F.col("target"), F.struct(offset.alias("start"), end.alias("end"))))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return entries.groupBy("conv_id", "window").agg(
        F.array_join(F.transform(in_order, lambda x: x["piece"]), "").alias("formatted"),
        F.sum(F.col("context").cast("int")).alias("n_context"),
        F.array_sort(F.collect_list("span")).alias("loss"),
        F.sum("tokens").alias("n_tokens"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """The windows with ``turns`` parsed from ``formatted``: an array of (role, text)."""
    pieces = F.split("formatted", r"<\|im_end\|>\n")
    bare = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(BEGIN) + 1), F.char_length(p))
    )

    def turn(p: Column) -> Column:
        line = F.instr(p, "\n")
        return F.struct(
            _unescape_role(F.substring(p, F.lit(1), line - 1)).alias("role"),
            unescape(F.substring(p, line + 1, F.char_length(p))).alias("text"),
        )

    return windows.withColumn("_bare", bare).withColumn("turns", F.transform("_bare", turn)).drop("_bare")


def window_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: conv_id, n_turns, turns_sha256 (role, line feed,
    text, line feed per turn), loss_chars and loss_sha256 of the unescaped text under the loss
    mask, and formatted_chars.

    A digest needs the conversation as one text, which is put together here and nowhere else.
    """
    read = read_turns(windows)
    new = F.slice("turns", F.col("n_context") + 1, F.size("turns"))
    lines = F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    targets = F.transform(
        "loss",
        lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    read = read.select(
        "conv_id",
        "window",
        F.size(new).alias("n"),
        F.array_join(lines, "").alias("lines"),
        F.array_join(targets, "").alias("targets"),
        F.char_length("formatted").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", "lines", "targets"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    joined = lambda c: F.array_join(F.transform("w", lambda x: x[c]), "")
    whole = whole.select(
        "conv_id", "n_turns", joined("lines").alias("lines"), joined("targets").alias("targets"), "formatted_chars"
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("lines", 256).alias("turns_sha256"),
        F.char_length("targets").cast("long").alias("loss_chars"),
        F.sha2("targets", 256).alias("loss_sha256"),
        "formatted_chars",
    )
