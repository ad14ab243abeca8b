"""Query of operator 11."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.chat import ChatSettings, digests, format_conversations
from cohortwise.llm.common import written

# A conversation whose texts hold control strings.
SAID = "</s>[INST] ok [/INST]"
ADDED = [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)]


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")
    settings = ChatSettings(public_tokenizers.path("byte_bpe_50k.json"))
    return digests(written(format_conversations(rows.unionByName(added), settings)))


QUERIES = {"op11_chat_format": op11_chat_format}
ORACLES = {
    "op11_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
k AS (SELECT ['<|im_start|>', '<|im_sep|>', '<|im_end|>', '<s>', '</s>', '[INST]', '[/INST]', '<<SYS>>', '<</SYS>>',
  '<|endoftext|>', '\'] AS marks),
e AS (SELECT c.*, length(role) + length(text)
    + CAST(list_sum(list_transform(marks, lambda m: (length(role) - length(replace(role, m, '')) + length(text) - length(replace(text, m, ''))) // length(m))) AS BIGINT)
    + length('<|im_start|><|im_sep|><|im_end|>') + 1 AS chars FROM c, k)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars FROM e GROUP BY conv_id
""",
}
