"""Deterministic stand-ins for models, as factories ``operators.models`` takes."""

from __future__ import annotations

import numpy as np


def answers(fixed_from: int = 8):
    """Answers exam items in a different manner for each remainder of the item number by 8.

    Remainders from ``fixed_from`` on are answered plainly, and so rightly.
    """

    def reply(item: int, gold: str) -> str:
        kind = item % 8
        plain = (
            gold,
            "答案是" + gold,
            "I think " + gold + ".",
            "选择 " + gold.lower(),
            "Definitely " + gold,
            "",
            "无",
            "我认为" + gold + "正确",
        )
        return gold if kind >= fixed_from else plain[kind]

    def load():
        def predict(chat: np.ndarray, item: np.ndarray, gold: np.ndarray) -> np.ndarray:
            return np.array([reply(int(i), g) for i, g in zip(item, gold, strict=True)], dtype=object)

        return predict

    return load


VARIANTS = {"base": answers(), "lora": answers(6), "grpo": answers(5)}


def text_features():
    """Four whole-number features of a text as its embedding."""

    def predict(text: np.ndarray) -> np.ndarray:
        return np.array([[len(t), t.count(" "), t.count("e"), 1] for t in text], dtype=np.float32)

    return predict


EMBEDDERS = {"document": text_features, "query": text_features}


def length_ratio():
    """Length of the completion by that of the prompt as the reward."""

    def predict(prompt: np.ndarray, completion: np.ndarray) -> np.ndarray:
        return np.array([len(c) / (len(p) + 1.0) for p, c in zip(prompt, completion, strict=True)])

    return predict
