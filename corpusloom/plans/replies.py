"""Untyped model replies for the queries of the instruction stages, made from the numbers of a row.

The tables hold no raw replies. These expressions are the input of both engines, hence written in what both read alike;
n and m are the row's numbers. They hold fields of every type, missing and null ones.
"""


def _pick(number: str, *cases: str) -> str:
    """One of the cases by number; a case is JSON text, with expressions between @ signs."""
    of = lambda c: "''" if not c else " || ".join(f"'{x}'" if k % 2 == 0 else f"CAST({x} AS STRING)" for k, x in enumerate(c.split("@")))
    return f"CASE {number} % {len(cases)} " + " ".join(f"WHEN {k} THEN {of(c)}" for k, c in enumerate(cases)) + " END"


def _object(*fields: str) -> str:
    return "'{' || " + " || ".join(fields) + " || '\"end\": 0}'"


#: A row's numbers, from sft_answers.
NUMBERS = ("length(coalesce(sft_question.question, '')) * 7 + question_index AS n", "length(coalesce(sft_answer.answer, '')) AS m")

VERDICT = _object(
    _pick("n", "", '"score": 7.5, ', '"score": " 8 ", ', '"score": null, ', '"score": "high", ', '"score": 12, ', '"score": @m % 11@, '),
    _pick("m", '"score2": 1, ', '"pass_filter": true, ', '"pass_filter": "Yes ", ', '"pass_filter": 0, ', '"pass_filter": 2, ', '"pass_filter": null, ', '"pass_filter": "no", '),
    _pick("(n + m)", "", '"suggested_action": " keep", ', '"suggested_action": "archive", ', '"suggested_action": "rewrite", '),
    _pick("(n + 2 * m)", "", '"risk_label": "public_safe", ', '"risk_label": " refuse_or_exclude ", ', '"risk_label": "odd", ', '"risk_label": null, '),
    _pick("(n + 3 * m)", "", '"issues": "vague", ', '"issues": ["a", "b"], ', '"issues": 5, ', '"issues": [], '),
    _pick("(2 * n + m)", "", '"quality_level": "", ', '"quality_level": "own", '),
    _pick("(3 * n + m)", "", '"answer_issue_type": "unsafe", ', '"answer_issue_type": "none", ', '"answer_issue_type": "what", ', '"answer_issue_type": "factual_risk", '),
    _pick("(5 * n + m)", "", '"reason": " why ", ', '"rewrite_suggestion": " better ", ', '"status": "judged", '),
)

EVAL = _object(
    _pick("n", "", '"recommended_question_count": @m % 6@, ', '"recommended_question_count": "2.5", ', '"recommended_question_count": "some", ', '"recommended_question_count": -1, ', '"recommended_question_count": 3, ', '"recommended_question_count": 4, '),
    _pick("m", "", '"recommended_question_types": "qa，summary/odd、plan", ', '"recommended_question_types": ["outline", "outline", " qa "], ', '"recommended_question_types": 3, '),
    _pick(
        "(n + m)", "", '"question_type_plan": "none", ', '"question_type_plan": [{"question_type": "qa", "count": @m % 4@}, 7, {"question_type": " plan ", "count": "2", "reason": " r "}], ',
        '"question_type_plan": [{"question_type": "odd", "count": 2}, {"question_type": "summary", "count": 0}], ', '"question_type_plan": [{"question_type": "rewrite"}, {"question_type": "critique", "count": null}, {"question_type": "qa", "count": 2.5}], ',
    ),
    _pick("(n + 2 * m)", "", '"issues": "short", "suggested_use": "train", ', '"reason": "fine", "question_count_reason": null, '),
)

QUESTIONS = _object(
    _pick(
        "n", "", '"question": " alone @m@ ", ', '"questions": [{"question": "根据材料：结合上文， first?", "question_type": "plan", "risk_label": "odd"}, {"question": "first?"}, 3, {"question": "second @m@", "difficulty": "hard", "target_label_id": "L1"}], ',
        '"questions": [], ', '"questions": [{"question": "  "}, {"question": "only @m@", "question_type": "odd", "expected_answer_format": "table", "reason": " r "}], ',
        '"questions": [{"question": "a"}, {"question": "b"}, {"question": "c"}, {"question": "d"}], ',
    ),
)

ANSWER = _object(_pick("n", "", '"answer": " text @m@ ", ', '"answer": null, ', '"answer": 7, ', '"answer": "  ", '), _pick("m", "", '"risk_label": "odd", ', '"risk_label": "needs_caution", ', '"quality_notes": " good ", '))

CHOICE = _object(
    _pick("n", "", '"primary_label_id": "F000@1 + m % 9@", ', '"primary_label_id": null, ', '"primary_label_id": "F9999", ', '"primary_label_id": "F0001", '), _pick("m", "", '"confidence": 1.5, ', '"confidence": "0.25", ', '"confidence": "sure", ', '"confidence": -1, '),
    _pick("(n + m)", "", '"task_types": "one", ', '"task_types": ["x", "y"], "source_type": "book", ', '"evidence_keywords": ["k"], "reason": "so", ', '"risk_label": " public_safe", '),
)
