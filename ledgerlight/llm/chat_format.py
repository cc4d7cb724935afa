"""Chat formatting in budgeted windows, with native functions only.

Template: every turn is ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``; roles are
percent-encoded and control strings inside texts are broken up by a backslash
after their first character (backslashes are doubled), so parsing is exact.

Windows are aligned to turns.  The prefix sum of turn tokens (default
``ceil(bytes / 4) + 4``) decides: turns that lie inside one stretch of ``stride``
tokens form a window, a turn that crosses a border of stretches is a window by
itself, where ``stride`` is the budget less the history's and the leading system
turn's tokens (at least a quarter of the budget).  So a window stays within the
budget unless its system turn or a single turn alone is longer.  Every window
repeats the leading system turn and up to ``history_turns`` earlier turns within
``history_tokens``; the loss mask covers assistant texts, each only in the window
where it is new.

Conversations are ordered by (turn, role, text); null role or text counts as
empty, null conv_id is one conversation, repeated rows are turns of their own.
Other columns are ignored; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# control strings of common chat templates; fixed values
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 1024, 256, 2


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def byte_tokens(text: Column) -> Column:
    """A token estimate: a quarter of the bytes, rounded up, and four for the turn's marks."""
    return (F.ceil(F.octet_length(text) / 4) + 4).cast("bigint")


def format_windows(conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
                   history_turns: int = HISTORY_TURNS, tokens=byte_tokens) -> DataFrame:
    """conv_id, window_no, text, n_repeated (leading repeated turns), loss_spans (character start, length)."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    to_here = order.rowsBetween(Window.unboundedPreceding, 0)
    system = (F.col("pos") == 1) & (F.col("role") == "system")
    rows = (turns.withColumn("pos", F.row_number().over(order))
            .withColumn("lead", system)
            .withColumn("system_text", F.max(F.when(F.col("lead"), F.col("text"))).over(to_here))
            .withColumn("tokens", F.when(F.col("lead"), F.lit(0)).otherwise(tokens(F.col("text"))))
            .withColumn("end", F.sum("tokens").over(to_here))
            .withColumn("begin", F.col("end") - F.col("tokens")))
    own = F.coalesce(tokens(F.col("system_text")), F.lit(0))
    stride = F.greatest(F.lit(budget - history_tokens) - own, F.lit(budget // 4))
    block = F.floor(F.col("begin") / F.col("stride"))
    crosses = F.floor((F.col("end") - 1) / F.col("stride")) > block
    rows = rows.withColumn("stride", stride).withColumn("span", block * 2 + F.when(crosses, 1).otherwise(0))
    rows = rows.withColumn("span", F.when(F.col("lead"), F.coalesce(F.lead("span").over(order), F.lit(0)))
                           .otherwise(F.col("span")))
    rows = rows.withColumn("opens", ~F.col("lead") & F.coalesce(F.col("span") != F.lag("span").over(order), F.lit(True)))
    later = []
    for h in range(1, history_turns + 1):
        ahead = [F.lead(c, h).over(order) for c in ("span", "opens", "begin")]
        reach = (~F.col("lead") & ahead[1] & (ahead[0] != F.col("span"))
                 & (ahead[2] - F.col("begin") <= history_tokens))
        later.append((F.when(reach, ahead[0])))
    rows = rows.withColumn("again", F.array(*later) if later else F.array().cast("array<bigint>"))
    turn = lambda span, pos, repeated, role, text: F.struct(
        span.cast("bigint").alias("span"), pos.alias("pos"), repeated.alias("repeated"), role.alias("role"),
        text.alias("text"))
    mine = turn(F.col("span"), F.col("pos"), F.lit(False), F.col("role"), F.col("text"))
    history = F.transform(F.filter("again", lambda s: s.isNotNull()),
                          lambda s: turn(s, F.col("pos"), F.lit(True), F.col("role"), F.col("text")))
    kept = F.when(F.col("opens") & (F.col("begin") > 0) & F.col("system_text").isNotNull(), F.array(
        turn(F.col("span"), F.lit(0), F.lit(True), F.lit("system"), F.col("system_text"))))
    parts = (rows.select("conv_id", F.explode(F.concat(F.array(mine), history, F.coalesce(kept, F.array())))
                         .alias("t")).select("conv_id", "t.*"))
    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    inside = Window.partitionBy("conv_id", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    parts = (parts.withColumn("head", head).withColumn("body", escape(F.col("text")))
             .withColumn("chars", F.length("head") + F.length("body") + len(END))
             .withColumn("at", F.sum("chars").over(inside) - F.col("chars")))
    loss = F.when(~F.col("repeated") & (F.col("role") == "assistant"),
                  F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("length")))
    seg = F.struct("pos", F.concat("head", "body", F.lit(END)).alias("s"), loss.alias("loss"))
    return (parts.groupBy("conv_id", "span")
            .agg(F.array_sort(F.collect_list(seg)).alias("segs"), F.count(F.when(F.col("repeated"), 1)).alias("n_repeated"))
            .select("conv_id", F.col("span").alias("window_no"), F.array_join("segs.s", "").alias("text"), "n_repeated",
                    F.filter("segs.loss", lambda x: x.isNotNull()).alias("loss_spans")))


def read_turns(windows: DataFrame) -> DataFrame:
    """Per window, parsed from its text: the new turns (role, text) and the unescaped text under the loss mask."""
    parts = F.split("text", r"<\|im_end\|>\n")
    new = F.slice(parts, F.col("n_repeated").cast("int") + 1, F.size(parts) - 1 - F.col("n_repeated").cast("int"))
    turn = lambda x: F.struct(
        F.url_decode(F.substring_index(F.substring(x, len(START) + 1, 2**31 - 1), "\n", 1)).alias("role"),
        unescape(F.substring(x, F.instr(x, "\n") + 1, F.length(x))).alias("text"))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.select("conv_id", "window_no", F.transform(new, turn).alias("turns"),
                          F.array_join(masked, "").alias("loss_text"), F.length("text").cast("bigint").alias("chars"))


def digest(windows: DataFrame) -> DataFrame:
    """Counts and checksums per conversation, read back from the formatted windows.

    A checksum over a whole conversation needs its text in one row, once.
    """
    turns = read_turns(windows)
    canon = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    per_window = turns.select("conv_id", "window_no", canon.alias("canon"), "loss_text", "chars",
                              F.size("turns").cast("bigint").alias("n"))
    joined = (per_window.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window_no", "canon", "loss_text"))).alias("w")))
    text, loss = F.array_join("w.canon", ""), F.array_join("w.loss_text", "")
    return joined.select("conv_id", "n_turns", F.sha2(text, 256).alias("turns_sha256"),
                         F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                         "formatted_chars")
