"""DuckDB SQL for the queries, written from the tables and without any JSON."""

from __future__ import annotations

from loomset.functions import PYTHON_WHITESPACE
from verify.rows import SYSTEM_PROMPT

# Rows of verify.rows.sft_lines: kind, error and turns of each document.
SFT = f"""
doc as (select doc_id, text, lang, n_chars, doc_id % 20 as k from documents),
row_kind as (
  select doc_id,
    case when k in (0, 4, 7, 9, 10, 12, 19) then 'messages'
         when k in (1, 2, 5, 8, 11) then 'instruction'
         when k in (3, 14, 17, 18) then 'prompt_completion'
         else '-' end as schema_kind,
    case k when 6 then 'UNKNOWN_SCHEMA' when 7 then 'INVALID_ROLE'
           when 8 then 'MISSING_RESPONSE' when 10 then 'MESSAGES_EMPTY'
           when 11 then 'MISSING_RESPONSE' when 12 then 'MESSAGE_KEYS'
           when 13 then 'UNKNOWN_SCHEMA' when 14 then 'NULL_FIELD'
           when 15 then 'BAD_JSON' when 16 then 'NOT_A_MAPPING'
           else '' end as error_code,
    case when k in (7, 12) then 1 else -1 end::bigint as error_index
  from doc),
own_turn as (
  select doc_id, 0 as i, 'system' as role, 'Be exact.' as content from doc where k = 4
  union all select doc_id, 1, 'user', text from doc where k in (0, 2, 3, 4, 5, 9, 17, 18, 19)
  union all select doc_id, 1, 'user', 'Name the language.' || chr(10) || chr(10) || text
            from doc where k = 1
  union all select doc_id, 2, 'system', 'late' from doc where k = 19
  union all select doc_id, 3, 'assistant', lang from doc where k in (0, 1, 2, 3, 4, 5, 9, 19)
  union all select doc_id, 3, 'assistant', case when n_chars > 1000 then 'True' else 'False' end
            from doc where k = 17
  union all select doc_id, 3, 'assistant', n_chars::varchar from doc where k = 18),
full_turn as (
  select * from own_turn
  union all select doc_id, 0, 'system', '{SYSTEM_PROMPT}'
            from own_turn where i = 1 and doc_id % 20 <> 4),
turn as (
  select doc_id, (row_number() over (partition by doc_id order by i) - 1)::bigint as turn,
    role, content from full_turn)
"""


def chatml(turns: str, key: str, order: str, role: str = "role", content: str = "content") -> str:
    return f"""select {key}, string_agg('<|im_start|>' || {role} || chr(10) || {content}
      || '<|im_end|>', chr(10) order by {order}) as text from {turns} group by {key}"""


def margin(content: str, order: str) -> str:
    """The text of verify.queries.margin_template, with a generation prompt."""
    blanks = " || ".join(f"chr({ord(c)})" for c in PYTHON_WHITESPACE)
    turn = f"lpad(role, 9, ' ') || ' > ' || trim({content}, {blanks})"
    return f"string_agg({turn}, chr(10) order by {order}) || chr(10) || 'assistant > '"


OPEN_TURN = "chr(10) || '<|im_start|>assistant' || chr(10)"

# Conversations with the system turn put first where there was none.
CONVERSATIONS = f"""
first_role as (select conv_id, arg_min(role, turn) as first_role from conversations group by 1),
turn as (
  select conv_id, turn, role, text from conversations
  union all select conv_id, -1, 'system', '{SYSTEM_PROMPT}' from first_role
            where first_role <> 'system')
"""

# Rows of verify.rows.preference_lines.
PREFERENCE = f"""
doc as (select doc_id, text, lang, doc_id % 8 as k from documents),
kinds as (
  select doc_id,
    case when k in (0, 3, 4, 7) then 'prompt' when k in (1, 5) then 'messages'
         when k = 2 then 'instruction' else '-' end as schema_kind,
    case k when 4 then 'PREF_MISSING_FIELDS' when 6 then 'UNKNOWN_SCHEMA'
           when 7 then 'NULL_FIELD' else '' end as error_code from doc),
turn as (
  select doc_id, 0 as i, 'system' as role,
    case when k = 5 then 'Be exact.' else '{SYSTEM_PROMPT}' end as content
  from doc where k in (0, 1, 2, 3, 5)
  union all select doc_id, 1, 'user', case when k = 2 then 'Go on.' || chr(10) || chr(10) || lang
    else lang end from doc where k in (0, 1, 2, 3, 5)
  union all select doc_id, 2, 'assistant', 'Well,' from doc where k = 5)
"""

PREFERENCE_EXAMPLE = f"""
with {PREFERENCE}, prompts as ({chatml("turn", "doc_id", "i")})
select doc_id, prompts.text || {OPEN_TURN} as prompt, doc.text as chosen,
  doc.text || ' Or not.' as rejected
from prompts join doc using (doc_id)
"""

# Rows of verify.rows.corpus_lines that are good and not empty.
CORPUS = """
corpus as (
  select doc_id, text from documents where text <> ''
  union all select -1 - doc_id, ' ' from documents where doc_id % 5 = 1)
"""

# The same, with empty texts.
CORPUS_ROWS = """
select doc_id as row_id, text as {0} from documents where text is not null
union all select -1 - doc_id, case doc_id % 5 when 0 then '' else ' ' end from documents
where doc_id % 5 < 2"""


def split(rows: str, fraction: float, key: str = "doc_id", tie: str = "doc_id") -> str:
    return f"""select *, case when rank_no <= ceil({fraction}::double * n) then 'eval'
      else 'train' end as split
    from (select *, count(*) over () as n,
            row_number() over (order by md5('42:' || {key}::varchar), {tie}) as rank_no
          from {rows})"""


CORPUS_SPLIT = f"with {CORPUS} select text, split from ({split('corpus', 0.05)})"

ORACLES: dict[str, str] = {
    "scan_jsonl": "select doc_id, text, source from documents",
    "scan_json": "select doc_id, text, source from documents",
    "json_document_corpus": CORPUS_SPLIT,
    "eval_file_precedence": f"""
        with {SFT}
        select text, 'train' as split from ({chatml("own_turn", "doc_id", "i")})
        union all
        select '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
          || '<|im_start|>assistant' || chr(10) || 'done<|im_end|>', 'eval' from benchmark""",
    "discover_corpus": f"with {CORPUS} select text from corpus",
    "route_split": """select doc_id, text,
        case when doc_id % 10 = 0 then 'validation' else 'train' end as split
        from documents where lang = 'fr'""",
    "profile_keys": """
        select case when k in (0, 4, 7, 9, 12, 19) then 'doc_id,messages'
            when k = 1 then 'context,doc_id,instruction,response'
            when k = 2 then 'doc_id,instruction,output'
            when k in (3, 14, 17, 18) then 'completion,doc_id,prompt'
            when k = 5 then 'context,doc_id,instruction,response'
            when k = 6 then 'doc_id,foo'
            when k = 8 then 'doc_id,instruction'
            when k = 10 then 'completion,doc_id,messages,prompt'
            when k = 11 then 'doc_id,instruction,output,response'
            when k = 13 then 'doc_id,prompt'
            else '-' end as keys, count(*) as n_rows
        from (select doc_id % 20 as k from documents) group by 1""",
    "detect_sft_schema": f"with {SFT} select doc_id as row_id, schema_kind from row_kind",
    "normalize_messages": f"""
        with {SFT}
        select doc_id as row_id,
          (row_number() over (partition by doc_id order by i) - 1)::bigint as turn, role, content
        from own_turn where doc_id % 20 in (0, 4, 9, 19)""",
    "instruction_to_messages": """
        select doc_id as row_id, case when doc_id % 20 = 1
            then 'Name the language.' || chr(10) || chr(10) || text else text end as user,
          lang as assistant
        from documents where doc_id % 20 in (1, 2, 5)""",
    "output_alias": """select doc_id as row_id, text as user, lang as assistant
        from documents where doc_id % 4 = 1""",
    "prompt_completion_to_messages": """
        select doc_id as row_id, text as user, case doc_id % 20 when 3 then lang
            when 17 then case when n_chars > 1000 then 'True' else 'False' end
            else n_chars::varchar end as assistant
        from documents where doc_id % 20 in (3, 17, 18)""",
    "prepend_system_prompt": f"""
        with {CONVERSATIONS}
        select conv_id, arg_min(role, turn) as role, arg_min(text, turn) as content,
          count(*) as n_turns from turn group by 1""",
    "to_chat_messages": f"with {SFT} select doc_id as row_id, turn, role, content from turn",
    "typed_table_messages": f"""
        with t as (
          select doc_id, 0::bigint as turn, 'system' as role, '{SYSTEM_PROMPT}' as content
            from documents where doc_id % 4 < 3
          union all select doc_id, 1, 'user', text from documents where doc_id % 4 < 3
          union all select doc_id, 2, 'assistant', case when doc_id % 4 = 2
            then n_chars::varchar else lang end from documents where doc_id % 4 < 3)
        select doc_id as row_id, turn, role, content from t""",
    "prune_columns": f"with {SFT} select text from ({chatml('own_turn', 'doc_id', 'i')})",
    "render_chatml": f"with {CONVERSATIONS} {chatml('turn', 'conv_id', 'turn', content='text')}",
    "render_generation_prompt": f"""
        select item_id, '<|im_start|>system' || chr(10) || '{SYSTEM_PROMPT}<|im_end|>' || chr(10)
          || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || {OPEN_TURN} as prompt
        from benchmark""",
    "render_bracket_template": f"""
        select conv_id, {margin("text", "turn")} as text from conversations group by 1""",
    "format_example": f"""
        with {SFT}
        select doc_id as row_id, text || {OPEN_TURN} as text
        from ({chatml("turn", "doc_id", "turn")})""",
    "preference_errors": f"""
        with {PREFERENCE} select doc_id as row_id, error_code from kinds where error_code <> ''""",
    "detect_preference_schema": f"""
        with {PREFERENCE} select doc_id as row_id, schema_kind from kinds""",
    "render_preference_prompt": f"""
        with {PREFERENCE}
        select doc_id as row_id, {margin("content", "i")} as prompt from turn group by 1""",
    "to_preference_example": f"""
        select doc_id as row_id, prompt, chosen, rejected from ({PREFERENCE_EXAMPLE})""",
    "corpus_project": CORPUS_ROWS.format("text"),
    "corpus_text_field": CORPUS_ROWS.format("body"),
    "drop_empty_text": """
        select doc_id, text from documents where text <> ''
        union all select doc_id, ' ' from documents where doc_id % 2 = 1""",
    "valid_role": """
        select conv_id, turn, (turn % 4 in (0, 2))::bigint as valid from conversations""",
    "classify_errors": f"""
        with {SFT} select doc_id as row_id, error_code, error_index from row_kind
        where error_code <> ''""",
    "error_summary": f"""
        with {SFT} select error_code, count(*) as n_rows from row_kind group by 1""",
    "holdout_split": f"select doc_id, split from ({split('documents', 0.05)})",
    "holdout_split_copies": f"select doc_id, split from ({split('documents', 0.3, 'text')})",
    "holdout_split_null_keys": """
        select doc_id, case when rank_no <= ceil(0.1::double * n) then 'eval' else 'train' end as split
        from (select doc_id, count(*) over () as n, row_number() over (order by
                case when doc_id % 2 = 0 then md5('42:' || doc_id::varchar) else md5('42') end,
                doc_id) as rank_no
              from documents)""",
    "holdout_split_layouts": """
        select ceil(0.2::double * count(*))::bigint as held_out, 2::bigint as least,
          2::bigint as most from documents""",
    "dataset_ready_count": f"""
        select split, count(*) as n_rows from ({split('documents', 0.07)}) group by 1""",
    "sft_dataset": f"""
        with {SFT}, texts as ({chatml("turn", "doc_id", "turn")})
        select text, split from ({split("texts", 0.1)})""",
    "text_corpus": CORPUS_SPLIT,
    "dpo_dataset": f"""
        with examples as ({PREFERENCE_EXAMPLE})
        select prompt, chosen, rejected, split from ({split("examples", 0.2)})""",
    "prep_job": CORPUS_SPLIT,
    "fail_on_error": """
        select doc_id as row_id, '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10)
          || '<|im_start|>assistant' || chr(10) || lang || '<|im_end|>' as text from documents""",
    "text_field_called_split": f"select text, split as part from ({CORPUS_SPLIT})",
    "write_roundtrip": f"select text, split from ({split('documents', 0.05)})",
}
ORACLES["render_with_template_fn"] = ORACLES["render_bracket_template"]
ORACLES["prep_job_sft"] = ORACLES["sft_dataset"]
ORACLES["prep_job_preference"] = ORACLES["dpo_dataset"]
ORACLES["profile_keys_preview"] = """
    select case when k in (0, 4, 9, 19) then 'doc_id,messages'
        when k in (1, 5) then 'context,doc_id,instruction,response'
        when k = 2 then 'doc_id,instruction,output'
        else 'completion,doc_id,prompt' end as keys, count(*) as n_rows, true as shown
    from (select doc_id % 20 as k from documents)
    where k in (0, 1, 2, 3, 4, 5, 9, 17, 18, 19) group by 1"""

# Layout of training input.  A text's tokens are the pieces between its blanks.

_COUNTED = "counted as (select *, len(string_split(text, ' ')) as n from documents where text <> '')"


def packed(length: int, separators: int = 1) -> str:
    """Pieces of sequences as ``piece``: where rows begin in the stream, cut every ``length``."""
    return f"""
        {_COUNTED},
        placed as (select *, n + {separators} as m, (sum(n + {separators}) over (order by doc_id))::bigint as en from counted),
        piece as (
          select unnest(generate_series((en - m) // {length}, (en - 1) // {length})) as seq_id, doc_id, text, en - m as st, en
          from placed where m > 0),
        span as (
          select seq_id, doc_id, text, st, en, greatest(st, seq_id * {length}) - st as tok_from,
            least(en, (seq_id + 1) * {length}) - st as tok_to from piece)"""


ORACLES |= {
    "token_counts": """
        select doc_id, n::int as n_tokens, n::int as n_called, case when n > 0 then length(text) - n + 1 else 0 end as id_sum
        from (select doc_id, text, case when text <> '' then len(string_split(text, ' ')) else 0 end as n from documents)""",
    "truncate_to_length": f"""
        with {_COUNTED}
        select doc_id, n::int as n_tokens, n > 64 as was_truncated,
          array_to_string(string_split(text, ' ')[:64], ' ') as text from counted""",
    "cap_preference_lengths": f"""
        with {_COUNTED}, kept as (select *, least(n, 100) as k from counted)
        select doc_id, n - k as prompt_from, n as prompt_to, least(n // 2, 160 - k) as chosen_to,
          least(1, 160 - k)::bigint as rejected_to, n > k or n // 2 > 160 - k as was_capped from kept""",
    "pack_sequences": f"with {packed(512)} select seq_id, doc_id, tok_from, tok_to from span",
    "pack_sequences_whole": f"""
        with {packed(32, 0)}
        select seq_id, doc_id, tok_from, tok_to, st + tok_from - seq_id * 32 as seq_from from span
        where seq_id < (select max(en) // 32 from placed)""",
    "packed_tokens": f"""
        with {packed(512)},
        token as (
          select doc_id, st, unnest(list_append(string_split(text, ' '), '<end>')) as t,
            unnest(range(len(string_split(text, ' ')) + 1)) as i
          from (select doc_id, text, en - m as st from placed))
        select (st + i) // 512 as seq_id, count(*) as n, md5(string_agg(t, ' ' order by st + i)) as digest
        from token group by 1""",
    "length_grouped_batches": f"""
        with {_COUNTED},
        ranked as (
          select doc_id, n, (row_number() over (order by md5('42:' || doc_id::varchar), doc_id) - 1) // 400 as mega from counted)
        select doc_id, mega * 50 + (row_number() over (partition by mega order by n desc, doc_id) - 1) // 8 as batch_id
        from ranked""",
    "session_slices": f"""
        with {packed(256)}
        select seq_id // 400 as session_id, seq_id // 4 as step, seq_id, doc_id, tok_from, tok_to from span""",
    "calibration_sample": """
        select doc_id, text from documents order by md5('42:' || doc_id::varchar), md5('42:' || text) limit 64""",
    "calibration_sample_by": """
        select lang, doc_id from documents qualify row_number() over (
          partition by lang order by md5('42:' || text), md5('42:' || doc_id::varchar)) <= 20""",
}

ORACLES["json_document_errors"] = """
    select doc_id, case doc_id % 100 when 7 then 'ROW_TOO_LARGE' when 9 then 'BAD_JSON' else '' end as error_code
    from documents"""
