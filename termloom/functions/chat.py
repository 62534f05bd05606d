"""Two-turn chats: building, rendering and taking them apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from termloom.functions.terms import say

# Turn markers and the rendered name of the answering role.
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"
RENDERED_ROLE = {"assistant": "model"}
USER_MARKER = "<start_of_turn>user\n"
RESPONSE_MARKER = "<start_of_turn>model\n"


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_messages(question: Column, answer: Column) -> Column:
    return F.array(_turn("user", question), _turn("assistant", answer))


def render_chat(messages: Column, prefix: str = "") -> Column:
    """Any number of turns as one text; ``prefix`` takes a begin-of-text mark where one is used."""

    def turn(message: Column) -> Column:
        role = message["role"]
        for stored, shown in RENDERED_ROLE.items():
            role = F.when(role == stored, shown).otherwise(role)
        return say(TURN_START, role, "\n", message["content"], TURN_END)

    return say(prefix, F.array_join(F.transform(messages, turn), "\n"))


def render_pair(question: Column, answer: Column, prefix: str = "") -> Column:
    """``render_chat`` of a question and its answer, without building the array."""
    return say(
        prefix, USER_MARKER, question, TURN_END, "\n", RESPONSE_MARKER, answer, TURN_END
    )


def render_prompt(question: Column, prefix: str = "") -> Column:
    """One user turn and an open model turn."""
    return say(prefix, USER_MARKER, question, TURN_END, "\n", RESPONSE_MARKER)


def response_spans(text: Column) -> Column:
    """Split a rendered chat into what is masked and what is trained on.

    Struct of the text up to and including the first response marker, the trained text of every
    response turn, and the trained share of all characters.
    """
    pieces = F.split(text, RESPONSE_MARKER, -1)  # the marker holds no pattern characters
    answered = F.size(pieces) > 1
    trained = F.transform(
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda piece: F.substring_index(piece, USER_MARKER, 1),
    )
    trained_chars = F.aggregate(trained, F.lit(0), lambda n, piece: n + F.length(piece))
    return F.struct(
        F.when(answered, say(F.get(pieces, F.lit(0)), RESPONSE_MARKER))
        .otherwise(text)
        .alias("prompt"),
        trained.alias("responses"),
        F.coalesce(F.try_divide(trained_chars.cast("double"), F.length(text)), F.lit(0.0)).alias(
            "response_share"
        ),
    )


def messages_to_eval(messages: Column) -> list[Column]:
    """Question and ground truth of a stored chat; a shorter chat is an error under ANSI mode."""
    return [
        messages[0]["content"].alias("question"),
        messages[1]["content"].alias("ground_truth"),
    ]


def preview(text: Column, chars: int = 200) -> Column:
    return F.substring(text, 1, chars)
