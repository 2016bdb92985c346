"""Fixed values.

Everything in this file has to equal what the evaluated project uses, or results differ.
The values are stated as they are, in their natural order.
"""

# --- fixed values: chat format -----------------------------------------------------------
SYSTEM_PROMPT = "You are a helpful customer support assistant."

BEGIN_MARK = "<|begin_of_text|>"
HEADER_OPEN = "<|start_header_id|>"
HEADER_CLOSE = "<|end_header_id|>\n\n"
MESSAGE_END = "<|eot_id|>"
SPECIAL_TOKEN_OPEN = "<|"
REPLY_WORD = "assistant"
CHAT_ROLES = ("system", "user", "assistant")

# --- fixed values: scoring ---------------------------------------------------------------
SUPPORT_KEYWORDS = (
    "order", "refund", "cancel", "ship", "help", "support", "return",
    "payment", "account", "track", "delivery", "policy", "assist",
)
SHORT_REPLY_CHARS = 20
COMMENTARY_REMARK = "Fine-tuned should be more specific and professional."

# --- fixed values: split, limits, report -------------------------------------------------
SEED = 42
TEST_SIZE = 0.05
EVAL_SUBSET_ROWS = 50
MAX_SEQ_LENGTH = 1024
DEFAULT_MAX_TOKENS = 192
COMPARISON_ROWS = 15
PROMPT_CELL_CHARS = 200
OUTPUT_CELL_CHARS = 300

# --- fixed values: held-out prompts, with the kind of test each one makes -----------------
TEST_PROMPTS = (
    ("I need to cancel my order #12345 as soon as possible.", "standard"),
    ("Where is my package? I ordered it 5 days ago.", "standard"),
    ("How do I get a refund for a defective product?", "standard"),
    ("I want to change the shipping address for my order.", "standard"),
    ("My payment was charged twice, please help.", "standard"),
    ("Can I return an item after 30 days?", "standard"),
    ("I need to cancle my order", "typo"),
    ("Order 98765 please cancel it", "structure"),
    ("What's the status of my refund request?", "standard"),
    ("How do I track my shipment?", "standard"),
    ("I need help with my account login.", "standard"),
    ("Cancel everything", "edge"),
    ("What's the weather today?", "out_of_scope"),
    ("I wanna get my money back for order X", "paraphrase"),
    ("Help me with a return - the item doesn't fit.", "standard"),
)

# --- fixed values: out-of-scope example and placeholder wording ----------------------------
FALLBACK_INTENT = "out_of_scope"
FALLBACK_REPLY = (
    "I'm here to help with orders, shipping, and account questions. How can I assist you?"
)
PLACEHOLDER_PHRASES = {"Order Number": "your order number"}

# --- fixed values: the characters Python's str.strip() and str.split() treat as blank ------
BLANK_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
