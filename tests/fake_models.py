"""Scorers that stand in for models."""

import json


def writer():
    def run(rows):
        out = []
        for r in rows:
            if r["id"] == 2:
                raise RuntimeError("no answer")
            texts = [f" t{k}{r['id']} " if r["id"] != 3 else "same" for k in range(r["count"])]
            out.append({"outputs": [{"text": t, "finish_reason": "length" if r["id"] == 4 and k == 1 else "stop", "stop_reason": None, "token_ids": [1, 2]} for k, t in enumerate(texts)]})
        return out

    return run


def judge():
    """Prefers the answer that is 'gold'; breaks down on 'boom'."""
    def run(rows):
        out = []
        for r in rows:
            text = r["instruction"].rsplit("\n\n", 1)[1]
            if "boom" in text:
                raise RuntimeError("boom")
            shown = json.loads(text)
            if "answer_a" in shown:
                a, b = (90 if shown[k] == "gold" else 40 for k in ("answer_a", "answer_b"))
                out.append({"output": json.dumps({"winner": "A" if a > b else "B", "score_a": a, "score_b": b, "confidence": "high", "reason": "r"})})
            else:
                s = {f"score_{k.lower()}": 90 if v == "gold" else 40 for k, v in shown.items()}
                out.append({"output": json.dumps({**s, **{f"reason_{k.lower()}": "r" for k in shown}, "confidence": "low"})})
        return out

    return run


def answers():
    def run(rows):
        if any("fail" in r["messages"] for r in rows):
            raise RuntimeError("turn failed")
        return [{"output": f"answer to {r['messages'][:20]}"} for r in rows]

    return run


def grader():
    return lambda rows: [{"content": "평가: fine 점수: 7" if "unreadable" not in r["prompt"] else "nothing"} for r in rows]
