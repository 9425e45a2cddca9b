"""Chat messages, prompts and their rendering."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text, naive_strip

# Texts of the prompts, and the turn markup.
INPUT_HEADING = "\n\n입력:\n"
SCHEMA_HEADING = "\n\n[SCHEMA]\n"
ASSISTANT_SYSTEM = (
    "당신은 다양한 분야의 전문가들이 제공한 지식과 정보를 바탕으로 만들어진 AI 어시스턴트입니다. "
    "사용자들의 질문에 대해 정확하고 유용한 답변을 제공하는 것이 당신의 주요 목표입니다."
)
SUMMARY_INSTRUCTION = "다음 텍스트를 한국어로 간단히 요약해주세요:\n"
SUMMARY_FIVE_INSTRUCTION = "다음 텍스트를 한국어로 간단히 요약하고, 관련된 5개의 키워드를 추출해주세요:\n"
SUMMARY_PAIR_INSTRUCTION = "다음 텍스트를 한국어로 간단히 요약 및 관련 키워를 추출해주세요:\n"
SUMMARY_KEYWORD_INSTRUCTION = "다음 텍스트를 한국어로 간단히 요약 및 관련 키워드를 추출해주세요:\n"
KEYWORD_QUESTION = "중요한 키워드 5개를 뽑아주세요."
SUMMARY_LABEL = "한국어 요약:"
KEYWORD_LABEL = "키워드:"
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"
TASK_LABEL = "Task:"
TABLE_LABEL = "\nSQL table: "
QUERY_LABEL = "\nSQL query:"

MESSAGES = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class TurnTemplate:
    """Markup of one turn: start + role + after_role + content + end + separator."""

    start: str = TURN_START
    after_role: str = "\n"
    end: str = TURN_END
    separator: str = "\n"
    role_names: dict[str, str] = field(default_factory=lambda: {"assistant": "model"})
    reply_role: str = "assistant"

    def role_label(self, role: Column) -> Column:
        label = role
        for name, shown in self.role_names.items():
            label = F.when(role == name, F.lit(shown)).otherwise(label)
        return label

    @property
    def reply_opening(self) -> str:
        """What opens a turn of the answering role; also the response marker."""
        return self.start + self.role_names.get(self.reply_role, self.reply_role) + self.after_role


TURNS = TurnTemplate()


def message(role: str, content: Column | str) -> Column:
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(*turns: tuple[str, Column | str]) -> Column:
    """Messages from (role, content) pairs."""
    return F.array(*[message(role, content) for role, content in turns]).cast(MESSAGES)


def user_content(question: Column, extra: Column | None = None) -> Column:
    """The cleaned question, followed by a cleaned extra input if there is one."""
    question = clean_text(question)
    if extra is None:
        return question
    extra = clean_text(extra)
    return F.concat(question, F.when(extra != "", F.concat(F.lit(INPUT_HEADING), extra)).otherwise(""))


def instruction_messages(
    question: Column, answer: Column, extra: Column | None = None, system: str = ""
) -> Column:
    """Messages of an instruction row; a blank system text gives no system message."""
    turns: list[tuple[str, Column | str]] = [
        ("user", user_content(question, extra)),
        ("assistant", clean_text(answer)),
    ]
    if system.strip():
        turns.insert(0, ("system", system.strip()))
    return messages(*turns)


def raw_instruction_messages(
    question: Column, answer: Column, system: str = ASSISTANT_SYSTEM
) -> Column:
    """Messages with a fixed system text and the fields as they are."""
    return messages(("system", system), ("user", question), ("assistant", answer))


def summary_pair(original: Column, summary: Column, keywords: Column) -> Column:
    """Training pair: ask for summary and keywords, answer with both."""
    return messages(
        ("user", F.concat(F.lit(SUMMARY_PAIR_INSTRUCTION), original)),
        (
            "assistant",
            F.concat(F.lit(SUMMARY_LABEL), summary, F.lit("\n" + KEYWORD_LABEL), keywords),
        ),
    )


def prompt_forms(text: Column, summary: Column) -> dict[str, Column]:
    """The prompt shapes over one text, by name."""
    return {
        "plain": messages(("user", text)),
        "with_instruction": messages(("user", F.concat(F.lit(SUMMARY_FIVE_INSTRUCTION), text))),
        "follow_up": messages(
            ("user", F.concat(F.lit(SUMMARY_INSTRUCTION), text)),
            ("assistant", summary),
            ("user", KEYWORD_QUESTION),
        ),
        "empty_reply": messages(
            ("user", text), ("assistant", summary), ("user", KEYWORD_QUESTION), ("assistant", "")
        ),
        "short_prefill": messages(("user", text), ("assistant", SUMMARY_LABEL + "\n")),
        "prefilled": messages(
            ("user", F.concat(F.lit(SUMMARY_KEYWORD_INSTRUCTION), text)),
            ("assistant", SUMMARY_LABEL + "\n" + KEYWORD_LABEL),
        ),
    }


def text2sql_text(
    question: Column, schema: Column | None, sql: Column, compat: bool = False, template: TurnTemplate = TURNS
) -> Column:
    """Question, schema section if any, and the SQL as the answer.

    The text ends with the end marker and no line break. ``compat`` keeps the
    word "None" for a null field.
    """
    tidy = naive_strip if compat else clean_text
    user = tidy(question)
    if schema is not None:
        section = tidy(schema)
        user = F.concat(user, F.when(section != "", F.concat(F.lit(SCHEMA_HEADING), section)).otherwise(""))
    return F.concat(
        F.lit(template.start + "user" + template.after_role),
        user,
        F.lit(template.end + template.separator + template.reply_opening),
        tidy(sql),
        F.lit(template.end),
    )


def text2sql_prompt(question: Column, schema: Column) -> Column:
    """The inference form of the same task."""
    return F.concat(F.lit(TASK_LABEL), question, F.lit(TABLE_LABEL), schema, F.lit(QUERY_LABEL))


def render(
    turns: Column, ending: str = "none", eos: str = "", template: TurnTemplate = TURNS
) -> Column:
    """Messages as one string.

    ``ending``: "none" closes every turn; "generation" also opens a reply turn;
    "continue" leaves the last turn open so its text can be continued.
    """
    if ending not in ("none", "generation", "continue"):
        raise ValueError(f"unknown ending {ending!r}")

    def opened(m: Column) -> Column:
        return F.concat(
            F.lit(template.start), template.role_label(m["role"]), F.lit(template.after_role), m["content"]
        )

    closing = template.end + template.separator
    if ending == "continue":
        # Turns are joined by the closing markup, so the last one stays open.
        return F.concat(F.array_join(F.transform(turns, opened), closing), F.lit(eos))
    text = F.array_join(F.transform(turns, lambda m: F.concat(opened(m), F.lit(closing))), "")
    return F.concat(text, F.lit((template.reply_opening if ending == "generation" else "") + eos))


