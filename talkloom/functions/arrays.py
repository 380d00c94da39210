"""Column functions on arrays of token ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkloom import constants as C


def limit_or_model(limit: int | str | None, model_limit: int) -> int:
    """T10. A missing limit, also the word "None" of a settings file, is the model's own."""
    return model_limit if limit is None or limit == "None" else int(limit)


def truncate_right(ids: Column, limit: int = C.CUTOFF_LEN) -> Column:
    """T3. The first `limit` ids."""
    return F.slice(ids, 1, limit)


def pad_right(ids: Column, length: int, pad_id: int) -> Column:
    """T4. Pad to exactly `length`; longer input is not cut here."""
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(0), length - F.size(ids))))


def attention_mask(ids: Column, length: int) -> Column:
    """T4. One for every id, zero for every pad."""
    padding = F.greatest(F.lit(0), length - F.size(ids))
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), padding))


def append_eos(ids: Column, eos_id: int, limit: int = C.OLDER_CUTOFF_LEN) -> Column:
    """T5. One EOS at the end, unless it is there already or the row is full."""
    missing = F.coalesce(F.get(ids, F.size(ids) - 1) != eos_id, F.lit(True))
    return F.when(missing & (F.size(ids) < limit), F.concat(ids, F.array(F.lit(eos_id)))).otherwise(ids)


def tagged_message(
    ids: Column, role_id: int, bos_id: int, eos_id: int, linebreak_id: int = C.LINEBREAK_ID
) -> Column:
    """T6. BOS, role, line break, the text's ids, EOS."""
    head = F.array(F.lit(bos_id), F.lit(role_id), F.lit(linebreak_id))
    return F.concat(head, ids, F.array(F.lit(eos_id)))


def context_ids(
    system_ids: Column,
    user_ids: Column,
    bos_id: int,
    eos_id: int,
    role_ids: Mapping[str, int] = C.ROLE_IDS,
    linebreak_id: int = C.LINEBREAK_ID,
) -> Column:
    """T6. Tagged system message, tagged user message, then the opening of the reply."""
    reply = F.array(F.lit(bos_id), F.lit(role_ids["bot"]), F.lit(linebreak_id))
    return F.concat(
        tagged_message(system_ids, role_ids["system"], bos_id, eos_id, linebreak_id),
        tagged_message(user_ids, role_ids["user"], bos_id, eos_id, linebreak_id),
        reply,
    )


def keep_last(ids: Column, limit: int) -> Column:
    """T6. The last `limit` ids, all of them when there are fewer."""
    return F.slice(ids, F.greatest(F.lit(1), F.size(ids) - limit + 1), F.lit(limit))
