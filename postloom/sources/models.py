"""A model behind an HTTP interface of chat completions, for the operators that take one; and logs of a program's run."""

from __future__ import annotations

import json
import logging
import os
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class HttpModel:
    """Answers a system text and a user text through POST {url} with a JSON body of model, messages, temperature and max_tokens; streamed answers are
    put together. The key is read on the executor from the environment variable key_env, so that it isn't in the plan. Errors are raised: attempts()
    in operators/labeling.py tries again."""

    url: str
    model: str
    key_env: str = "MODEL_API_KEY"
    temperature: float = 0.0
    max_tokens: int = 3000
    timeout: float = 120.0
    stream: bool = False

    def __call__(self, system: str, user: str) -> str:
        body = {"model": self.model, "temperature": self.temperature, "max_tokens": self.max_tokens, "stream": self.stream, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}]}
        headers = {"Content-Type": "application/json"}
        if key := os.environ.get(self.key_env):
            headers["Authorization"] = f"Bearer {key}"
        with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(body).encode(), headers), timeout=self.timeout) as answer:
            if not self.stream:
                return json.load(answer)["choices"][0]["message"]["content"]
            parts = []
            for line in answer:
                data = line.decode("utf-8").strip().removeprefix("data:").strip()
                if data and data != "[DONE]":
                    parts += [c.get("delta", {}).get("content") or "" for c in json.loads(data).get("choices", [])]
            return "".join(parts)


def label_model(chat: Callable[[str, str], str], prompt: str) -> Callable[[list[dict]], str]:
    """For labeling.label(): the posts as a JSON list after the prompt."""
    return lambda posts: chat(prompt, json.dumps(posts, ensure_ascii=False))


def map_model(chat: Callable[[str, str], str], prompt: str) -> Callable[[str, list[str], list[str], list[str]], str]:
    """For vocabulary.map_pass()."""
    return lambda domain, seeds, vocabulary, labels: chat(prompt, json.dumps({"domain": domain, "vocabulary": vocabulary, "labels": labels}, ensure_ascii=False))


def seed_model(chat: Callable[[str, str], str], prompt: str) -> Callable[[str, list[tuple[str, int]], tuple[int, int]], str]:
    """For vocabulary.seed_pass()."""
    return lambda domain, labels, hint: chat(prompt, json.dumps({"domain": domain, "labels": [list(x) for x in labels], "expected": list(hint)}, ensure_ascii=False, default=int))


def pair_model(chat: Callable[[str, str], str], prompt: str) -> Callable[[list[tuple[str, str]]], str]:
    """For audit.audit_pairs()."""
    return lambda pairs: chat(prompt, "\n".join(f"{k}. LABEL: {a}  CANONICAL: {b}" for k, (a, b) in enumerate(pairs)))


def group_model(chat: Callable[[str, str], str], prompt: str) -> Callable[[list[str]], str]:
    """For audit.audit_groups()."""
    return lambda labels: chat(prompt, "\n".join(f"- {x}" for x in labels))


def log_to(path: str | None, name: str = "postloom") -> logging.Logger:
    """The logger with everything going to a file, if one is named, and warnings to the console. Called again, it replaces its own handlers."""
    log = logging.getLogger(name)
    log.setLevel(logging.DEBUG)
    for h in [h for h in log.handlers if getattr(h, "_postloom", False)]:
        log.removeHandler(h)
        h.close()
    handlers = [(logging.StreamHandler(), logging.WARNING)] + ([(logging.FileHandler(path, encoding="utf-8"), logging.DEBUG)] if path else [])
    for h, level in handlers:
        h.setLevel(level)
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        h._postloom = True
        log.addHandler(h)
    return log
