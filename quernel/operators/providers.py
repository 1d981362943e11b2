"""Models behind one interface: a registry of providers, requests and replies by dialect, conversations as tables.

A provider maps a series of prompts to a series of replies (``operators.incremental``). Those here speak HTTP; how a
request is sent is a parameter, so tests and closed networks need no server.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.text import chat_role
from quernel.operators.incremental import Provider, echo, offline
from quernel.operators.render import lines_by

#: Sends (url, headers, body) and gives the reply's body.
Transport = Callable[[str, dict, dict], dict]


def post(url: str, headers: dict, body: dict, timeout: float = 60) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310 - the address is the operator's own setting
        return json.load(reply)


class Dialect(Protocol):
    """How a back-end wants to be asked and where its answer stands."""

    def __call__(self, settings: dict, messages: list[dict]) -> tuple[str, dict, dict]: ...

    def answer(self, reply: dict) -> str: ...


class _OpenAI:
    def __call__(self, settings, messages):
        body = {"model": settings["model"], "messages": messages, "temperature": settings.get("temperature", 0.0), "max_tokens": settings.get("max_output_tokens", 4096)}
        return settings["api_base"].rstrip("/") + "/chat/completions", {"Authorization": f"Bearer {settings.get('api_key', '')}"}, body

    def answer(self, reply):
        return reply["choices"][0]["message"]["content"]


class _Claude:
    def __call__(self, settings, messages):
        system = "\n".join(m["content"] for m in messages if m["role"] == "system")
        body = {"model": settings["model"], "max_tokens": settings.get("max_output_tokens", 4096), "messages": [m for m in messages if m["role"] != "system"]}
        return settings["api_base"].rstrip("/") + "/messages", {"x-api-key": settings.get("api_key", "")}, body | ({"system": system} if system else {})

    def answer(self, reply):
        return "".join(p.get("text", "") for p in reply["content"])


class _Gemini:
    def __call__(self, settings, messages):
        turns = [{"role": "model" if m["role"] == "assistant" else "user", "parts": [{"text": m["content"]}]} for m in messages]
        url = f"{settings['api_base'].rstrip('/')}/models/{settings['model']}:generateContent"
        return url, {"x-goog-api-key": settings.get("api_key", "")}, {"contents": turns, "generationConfig": {"maxOutputTokens": settings.get("max_output_tokens", 4096)}}

    def answer(self, reply):
        return "".join(p.get("text", "") for p in reply["candidates"][0]["content"]["parts"])


#: Servers of open models speak the first dialect.
DIALECTS: dict[str, Dialect] = {"openai": _OpenAI(), "huggingface": _OpenAI(), "claude": _Claude(), "gemini": _Gemini()}


def http_provider(settings: dict, transport: Transport = post) -> Provider:
    """A provider of one of ``DIALECTS`` (``settings['type']``). A failing call raises; ``enrich`` keeps it as a row's error."""
    dialect, system = DIALECTS[settings["type"]], settings.get("system")

    def ask(prompts: pd.Series) -> pd.Series:
        def one(prompt: str) -> str:
            messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": prompt or ""}]
            return dialect.answer(transport(*dialect(settings, messages)))

        return prompts.map(one)

    return ask


_REGISTRY: dict[str, Callable[[dict], Provider]] = {"offline": lambda _: offline, "echo": lambda _: echo} | dict.fromkeys(DIALECTS, http_provider)


def register(name: str, make: Callable[[dict], Provider]) -> None:
    """Adds a kind of provider, made out of its settings."""
    _REGISTRY[name] = make


def create(settings: dict) -> Provider:
    """The provider of ``settings['type']`` (``offline`` if it has none); an unknown type raises."""
    kind = str(settings.get("type") or "offline").lower()
    if kind not in _REGISTRY:
        raise ValueError(f"unknown provider {kind!r}; known are {sorted(_REGISTRY)}")
    return _REGISTRY[kind](settings | {"type": kind})


def setting(config: dict, agent: str, *names: str, default=None):
    """The first of ``names`` that is set for an agent: in its own section, in that of its model, then in the general one."""
    places = [config.get("agents", {}).get(agent) or {}, (config.get("agents", {}).get(agent) or {}).get("llm") or {}, config.get("llm") or {}, config]
    return next((p[n] for p in places for n in names if p.get(n) is not None), default)


def token_limits(config: dict, agent: str) -> tuple[int | None, int | None]:
    """(greatest input, greatest output) of an agent in tokens, None where nothing says it."""
    return setting(config, agent, "max_input_tokens"), setting(config, agent, "max_output_tokens", "max_tokens")


# Conversations: rows (conversation, turn, role, content).


def remember(turns: DataFrame, new: DataFrame, conversation: str = "conversation") -> DataFrame:
    """``turns`` with one more turn per row of ``new`` (conversation, role, content), numbered after the last; a conversation without
    turns begins at 0. ``new`` has at most one row per conversation."""
    last = turns.groupBy(conversation).agg(F.max("turn").alias("_last"))
    added = new.join(last, conversation, "left").select(conversation, (F.coalesce("_last", F.lit(-1)) + 1).alias("turn"), "role", "content")
    return turns.unionByName(added)


def refreshed(turns: DataFrame, kept: DataFrame, conversation: str = "conversation") -> DataFrame:
    """Conversations of ``kept`` start anew with its rows; the others stay."""
    return turns.join(kept.select(conversation).distinct(), conversation, "left_anti").unionByName(kept.select(*turns.columns))


def prompts_of(turns: DataFrame, conversation: str = "conversation", turn: str = "turn", role: str = "role", content: str = "content") -> DataFrame:
    """(conversation, prompt): all turns as one text, as models without roles want it; unknown roles are left out."""
    # The names of the roles, and how a prompt ends.
    plain = chat_role(role)
    known = F.lower(role).isin("system", "user", "human", "assistant", "ai")
    name: Column = F.when(plain == "system", "System: ").when(plain == "assistant", "Assistant: ").otherwise("Human: ")
    lines = turns.withColumn("_known", known).groupBy(conversation).agg(lines_by([turn], F.when(F.col("_known"), F.concat(name, F.coalesce(content, F.lit("")))).otherwise(None)).alias("p"))
    return lines.select(conversation, F.concat(F.when(F.col("p") != "", F.concat("p", F.lit("\n"))).otherwise(""), F.lit("Assistant: ")).alias("prompt"))
