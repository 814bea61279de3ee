"""Schemas of the records the engine reads; sources never infer types."""

MESSAGES = "array<struct<role:string,content:string>>"
QUESTIONS = "id long, category string, questions array<string>, references array<string>"
TASKS = f"id long, category string, prompt {MESSAGES}, chosen string"
CANDIDATE = "struct<candidate_index:int,worker_id:string,seed:long,text:string,finish_reason:string,stop_reason:string,output_tokens:int>"
WORKER_OUTPUT = f"id long, category string, candidates array<{CANDIDATE}>"
REVIEWS = "id long, category string, decision string, chosen_source string, rejected_source string, gemma_status string, reason string, confidence string"
PAIRS = f"id long, category string, prompt {MESSAGES}, chosen string, rejected string, review struct<decision:string,chosen_source:string,rejected_source:string,gemma_status:string,reason:string,confidence:string>"
SFT = f"messages {MESSAGES}, meta struct<question_id:long,category:string,source_model:string,source_path:string,turn:int>"
JUDGED = "struct<judge_message:string,judge_score:double>"
EVALUATED = f"id long, category string, questions array<string>, references array<string>, outputs array<string>, query_single {JUDGED}, query_multi {JUDGED}, judge_single_score double, judge_multi_score double"

#: The closed, ordered set of training categories (fixed values).
CATEGORIES = ["추론", "수학", "코딩", "이해", "글쓰기", "문법"]
