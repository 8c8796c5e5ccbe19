"""Column expressions."""

from loomset.functions.barrier import bind, evaluate_once
from loomset.functions.chat import (
    MESSAGES_TYPE,
    ROLES,
    Renderer,
    message,
    prepend_system_prompt,
    render_chatml,
    render_template,
    template_renderer,
    valid_role,
)
from loomset.functions.jsontext import (
    JSON_PARSER,
    MAX_DEPTH,
    one_value,
    parse_json,
    with_length,
)
from loomset.functions.pytext import (
    PYTHON_WHITESPACE,
    may_not_be_string,
    py_strip,
    truthy_typed_text,
    truthy_variant_text,
    typed_text,
    variant_text,
)
from loomset.functions.tokens import BLANKS, Tokenizer, python_tokenizer, split_tokens, token_slice

__all__ = [
    "BLANKS",
    "JSON_PARSER",
    "MAX_DEPTH",
    "MESSAGES_TYPE",
    "PYTHON_WHITESPACE",
    "ROLES",
    "Renderer",
    "Tokenizer",
    "bind",
    "evaluate_once",
    "may_not_be_string",
    "message",
    "one_value",
    "parse_json",
    "prepend_system_prompt",
    "py_strip",
    "python_tokenizer",
    "render_chatml",
    "render_template",
    "split_tokens",
    "template_renderer",
    "token_slice",
    "truthy_typed_text",
    "truthy_variant_text",
    "typed_text",
    "valid_role",
    "variant_text",
    "with_length",
]
