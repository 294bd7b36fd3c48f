"""Chat formatting (operator 4): a finite-state machine over the roles checks
the turn order, and a declarative template turns each conversation into text
segments with a loss flag each. DataFrame functions only.

Cases: null text or role counts as empty; turns are ordered by turn (null
first), then role, then text, so ties and repeated rows have one defined order
and are all kept; rows with a null conv_id form one conversation; an empty
table gives no rows (the query still gives its own conversation -1); other
columns are ignored. A conversation is one value (its text and digest), so its
rows meet in one task.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import table


@dataclass(frozen=True)
class Template:
    """How turns are written. A turn is ``open + role + sep + text + close``;
    the text of a role in ``loss`` carries the loss flag. ``reserved`` strings
    are escaped in texts and roles besides the template's own marks.
    ``moves`` is the machine: state -> role -> next state, from ``start``;
    a conversation may end in any state of ``final``."""

    open: str = "<|im_start|>"
    sep: str = "\n"
    close: str = "<|im_end|>\n"
    loss: tuple[str, ...] = ("assistant",)
    reserved: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
                                 "<<SYS>>", "<</SYS>>")
    start: str = "start"
    final: tuple[str, ...] = ("user", "assistant")
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    })

    @property
    def codes(self) -> list[tuple[str, str]]:
        """(string, its escape): the escape sign itself first, longer strings
        before shorter ones."""
        marks = {self.open, self.close.strip() or self.close, *self.reserved}
        if any("\\" in m or not m for m in marks):
            raise ValueError("control strings must not be empty or hold a backslash")
        return [("\\", "\\."), *((m, "\\" + chr(0x61 + i))
                                 for i, m in enumerate(sorted(marks, key=lambda m: (-len(m), m))))]


def escape(text: Column, template: Template) -> Column:
    """Text without control strings. The result holds a backslash only as the
    first sign of an escape, so :func:`unescape` gives the text back."""
    for plain, code in template.codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, template: Template) -> Column:
    for plain, code in reversed(template.codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role(role: Column, template: Template) -> Column:
    """A role as it is written: also without the separator."""
    return F.replace(escape(role, template), F.lit(template.sep), F.lit("\\_"))


def machine(turns: Column, template: Template) -> Column:
    """State after all turns, or ``error:<place of the first bad turn>``."""
    step = F.create_map(*[F.lit(x) for state, to in template.moves.items()
                          for role, nxt in to.items() for x in (f"{state}\n{role}", nxt)])

    def move(acc: Column, turn: Column) -> Column:
        nxt = F.try_element_at(step, F.concat(acc["state"], F.lit("\n"), turn["role"]))
        bad = acc["state"].startswith("error:")
        return F.struct(
            F.when(bad, acc["state"]).otherwise(F.coalesce(nxt, F.concat(F.lit("error:"), acc["at"].cast("string")))).alias("state"),
            (acc["at"] + 1).alias("at"))

    first = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"))
    return F.aggregate(turns, first, move)["state"]


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation: conv_id, ``segments`` (array of text, loss),
    ``formatted`` (the segments' texts joined), ``state`` of the machine and
    ``valid``."""
    t = template or Template()
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    flagged = lambda role: role.isin(*t.loss) if t.loss else F.lit(False)
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(
        piece(F.concat(F.lit(t.open), _role(x["role"], t), F.lit(t.sep)), F.lit(False)),
        piece(escape(x["text"], t), flagged(x["role"])),
        piece(F.lit(t.close), F.lit(False)))))
    state = machine(F.col("turns"), t)
    return (chats.select("conv_id", segments.alias("segments"), state.alias("state"))
            .select("conv_id", "segments",
                    F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
                    "state", F.col("state").isin(*t.final).alias("valid")))


def read_back(formatted: Column, template: Template | None = None) -> Column:
    """The turns (array of role, text) of a formatted conversation, from its
    text alone."""
    t = template or Template()
    parts = F.filter(F.split(formatted, _literal(t.open), -1), lambda p, i: i > 0)

    def turn(part: Column) -> Column:
        cut = F.instr(part, t.sep)
        role = F.replace(F.substring(part, F.lit(1), cut - 1), F.lit("\\_"), F.lit(t.sep))
        start = cut + len(t.sep)
        text = F.substring(part, start, F.length(part) - start + 1 - len(t.close))
        return F.struct(unescape(role, t).alias("role"), unescape(text, t).alias("text"))

    return F.transform(parts, turn)


def _literal(s: str) -> str:
    return "\\Q" + s + "\\E"


def op4_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted; the turns are read
    back from the formatted text, the loss text from the flagged segments:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid."""
    t = Template()
    own = spark.sql("""
        SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)""")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    back = format_chats(turns, t).select(
        "conv_id", "valid", "formatted", read_back(F.col("formatted"), t).alias("turns"),
        F.concat_ws("", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], t))).alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
               .cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP4_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\.'),
    '<|endoftext|>', '\\a'), '<|im_start|>', '\\b'), '<|im_end|>', '\\c'), '<</SYS>>', '\\d'), '<<SYS>>', '\\e'),
    '[/INST]', '\\f'), '[INST]', '\\g'), '</s>', '\\h'), '<s>', '\\i') AS escaped,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(role) + 1 + length(escaped) + 11)::BIGINT AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                WHEN before IN ('system', 'assistant') THEN role = 'user'
                ELSE before = 'user' AND role = 'assistant' END) AND arg_max(role, (turn, role, text)) <> 'system' AS valid
FROM esc GROUP BY conv_id
"""
