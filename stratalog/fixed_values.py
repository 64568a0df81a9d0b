"""Default vocabularies, alias tables and thresholds.

Every operator takes these as parameters; nothing below is hard-wired into a plan.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# They must be exactly these for the results to be right.
# ---------------------------------------------------------------------------

DOMAINS = [
    "General", "Code", "Vision", "Multimodal", "Embedding", "Reasoning", "Math",
    "Medical", "Science", "Language", "Audio", "Finance", "Legal", "Education",
]
DOMAIN_DEFAULT = "General"
DOMAIN_ALIASES = {
    "natural language processing": "Language", "nlp": "Language", "language": "Language",
    "general purpose": "General", "general": "General", "text": "General",
    "code": "Code", "coding": "Code", "programming": "Code",
    "vision": "Vision", "image": "Vision",
    "multimodal": "Multimodal", "multi-modal": "Multimodal",
    "embedding": "Embedding", "embeddings": "Embedding",
    "reasoning": "Reasoning", "logic": "Reasoning",
    "math": "Math", "mathematics": "Math", "mathematical": "Math",
    "medical": "Medical", "medicine": "Medical", "health": "Medical",
    "science": "Science", "scientific": "Science",
    "audio": "Audio", "speech": "Audio",
    "finance": "Finance", "financial": "Finance",
    "legal": "Legal", "law": "Legal",
    "education": "Education", "educational": "Education",
}

USE_CASES = [
    "Chat Assistant", "Role Play", "Creative Writing",
    "Code Generation", "Code Review", "Code Explanation",
    "Question Answering", "Reasoning", "Math", "Text Summarization", "Translation",
    "RAG / Retrieval", "Text Embedding",
    "Image Understanding", "Video Understanding", "Audio Processing",
    "Function Calling", "Agent / Automation",
    "Data Analysis", "Document Processing",
]
USE_CASE_DEFAULT = "Chat Assistant"
USE_CASE_ALIASES = {
    "mathematics": "Math", "mathematical reasoning": "Math",
    "text analysis": "Data Analysis", "analysis": "Data Analysis",
    "information retrieval": "RAG / Retrieval", "retrieval": "RAG / Retrieval",
    "rag": "RAG / Retrieval",
    "content generation": "Creative Writing", "content creation": "Creative Writing",
    "document classification": "Document Processing", "classification": "Document Processing",
    "general purpose language models": "Chat Assistant", "general purpose": "Chat Assistant",
    "instruction following": "Chat Assistant",
    "embeddings": "Text Embedding", "text embeddings": "Text Embedding",
    "image understanding": "Image Understanding", "vision": "Image Understanding",
    "audio processing": "Audio Processing", "speech": "Audio Processing",
    "automation": "Agent / Automation", "agent": "Agent / Automation",
    "function calling": "Function Calling", "tool use": "Function Calling",
}

LANGUAGES = [
    "English", "Multilingual",
    "Chinese", "Japanese", "Korean", "Vietnamese", "Thai", "Indonesian", "Hindi",
    "Arabic", "Persian", "Turkish", "Urdu",
    "French", "German", "Spanish", "Portuguese", "Italian", "Russian", "Polish",
    "Dutch", "Swedish", "Romanian", "Czech", "Ukrainian",
]
LANGUAGE_DEFAULT = "English"
LANGUAGE_CAP = 8
# Every language except English is an alias of itself in lower case, and these two
# spellings are added. "english" is deliberately no alias.
LANGUAGE_ALIASES = {
    **{name.lower(): name for name in LANGUAGES if name != "English"},
    "multi-lingual": "Multilingual",
    "mandarin": "Chinese",
}

AUDIENCES = [
    "Developers", "Beginners", "Researchers", "Data Scientists", "DevOps", "Students",
    "Content Creators", "Educators", "Medical Professionals", "Legal Professionals",
    "Business Analysts",
]
AUDIENCE_DEFAULT = "Developers"
AUDIENCE_CAP = 4
# Singular and plural in lower case; "devops" has one form only.
AUDIENCE_ALIASES = {
    **{name.lower(): name for name in AUDIENCES},
    **{name.lower()[:-1]: name for name in AUDIENCES if name != "DevOps"},
}

FAMILIES = [
    "Llama", "Mistral", "Gemma", "Phi", "Qwen", "DeepSeek", "Yi", "Command", "Falcon",
    "Granite", "Orca", "Dolphin", "BLOOM", "BERT", "Nomic", "mxbai", "LLaVA", "Moondream",
    "BakLLaVA", "Vicuna", "WizardLM", "CodeLlama", "StarCoder", "SQLCoder", "OpenHermes",
    "Other",
]
FAMILY_DEFAULT = "Other"
# Ordered: the first one contained in the value wins, so "codellama" is Llama.
FAMILY_ALIASES = [
    ("llama", "Llama"), ("llama3", "Llama"), ("llama2", "Llama"),
    ("mistral", "Mistral"), ("mixtral", "Mistral"),
    ("gemma", "Gemma"), ("phi", "Phi"), ("qwen", "Qwen"),
    ("deepseek", "DeepSeek"), ("yi", "Yi"), ("command", "Command"), ("falcon", "Falcon"),
    ("granite", "Granite"), ("orca", "Orca"), ("dolphin", "Dolphin"),
    ("bloom", "BLOOM"), ("bert", "BERT"), ("nomic", "Nomic"), ("mxbai", "mxbai"),
    ("llava", "LLaVA"), ("llava:", "LLaVA"), ("moondream", "Moondream"),
    ("bakllava", "BakLLaVA"),
    ("vicuna", "Vicuna"), ("wizardlm", "WizardLM"), ("codellama", "CodeLlama"),
    ("starcoder", "StarCoder"), ("sqlcoder", "SQLCoder"), ("openhermes", "OpenHermes"),
]

COMPLEXITIES = ["beginner", "intermediate", "advanced"]
COMPLEXITY_DEFAULT = "intermediate"
COMPLEXITY_ALIASES = {
    "beginner": "beginner", "easy": "beginner", "simple": "beginner",
    "intermediate": "intermediate", "medium": "intermediate",
    "advanced": "advanced", "expert": "advanced", "hard": "advanced",
}

CAPABILITY_TAGS = ["vision", "tools", "embedding", "code", "thinking", "cloud"]
FLAG_KEYWORDS = [
    "uncensored", "abliterated", "ablation", "no-restrictions",
    "jailbreak", "dan", "dolphin", "instruct-no-filter",
]
NULL_WORDS = ["unknown", "n/a"]

LICENSE_TERMS = [
    r"MIT", r"Apache[\s\-]2\.0", r"Llama[\s\w]*License", r"Gemma[\s\w]*(?:Terms|License)",
    r"DeepSeek License", r"Qwen License", r"CC BY[\s\d\.]+", r"GPL[\s\-]?\d?", r"AGPL",
    r"Proprietary", r"Commercial", r"Apache License",
]
BENCHMARK_NAMES = [
    "MMLU", "HumanEval", "GSM8K", "SWE-bench", "MATH", "HellaSwag", "ARC", "MBPP", "BigBench",
    "TruthfulQA", "WinoGrande", "PIQA", "GPQA", "AIME", "AMC",
]
MENTION_HOST = "huggingface.co"

QUANT_DEFAULT = "q4_k_m"
RAM_FACTOR = 1.25
FAST_MAX_GB = 2.5
MEDIUM_MAX_GB = 6.0
UNSIZED_SORT_KEY = 999.0

README_CAP = 10000
SECTION_CAP = 2500
CLEAN_CAP = 1200
PROMPT_README_CAP = 500

MAX_VALIDATION_RETRIES = 3

# Export field names that differ from the catalog's column names.
EXPORT_NAMES = {"item_key": "model_identifier", "item_name": "model_name", "item_type": "model_type"}
