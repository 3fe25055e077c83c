"""The same results in plain SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

# Each helper is a list of common table expressions; `events` hold one sequence of user ids.
_LENGTH = "n as (select count(*) as n from events)"


def _cells(w: int, s: int, source: str = "events", pos: str = "event_id", token: str = "user_id") -> str:
    """Cells of all full windows: window k, place t, token."""
    reach = w // s
    return f"""
cells as (
  select e.{pos} // {s} - d.d as k, e.{pos} - (e.{pos} // {s} - d.d) * {s} as t, e.{token} as token
  from {source} e, range(0, {reach + 1}) d(d)
  where e.{pos} // {s} - d.d between 0 and (select ((select count(*) from {source}) - {w + 1}) // {s})
    and e.{pos} - (e.{pos} // {s} - d.d) * {s} <= {w}
    and (select count(*) from {source}) >= {w + 1})"""


def _vocab(w: int) -> str:
    """Tokens numbered from 1: all inputs in window order first, then targets."""
    return f"""
firsts as (
  select token, min((case when t = {w} then 1 else 0 end, k, t)) as key from cells group by token),
vocab as (select token, row_number() over (order by key) as idx from firsts)"""


_ORDERS = """
numbered as (select row_number() over (order by o_orderkey) - 1 as pos, o_custkey as token from orders)"""

_CELLS = _cells(64, 32)
_VOCAB = f"{_CELLS}, {_vocab(64)}"
_SPARSE = _cells(4, 97, "numbered", "pos", "token")
_SPARSE_VOCAB = f"{_SPARSE}, {_vocab(4)}"
# The usual cells, but the vocabulary of sparse windows over the same events.
_USUAL_WITH_SPARSE_VOCAB = f"""
{_cells(4, 97)}, {_vocab(4)}, {_CELLS.replace("cells as", "usual as", 1)}"""

_WIDE = "range(1, 65)::double[]"
_ZERO = "[0.0::double for x in range(0, 64)]"
_VECS = "vecs as (select vec_id as idx, embedding::double[] as vec from embeddings)"

_POSITION = """
case when j % 2 = 0 then sin(t / pow(10000.0, 2.0 * (j // 2) / 64))
     else cos(t / pow(10000.0, 2.0 * (j // 2) / 64)) end"""

# One row per feature cell: window k, place t, component j, value c.
_FEATURES = f"""
{_VOCAB}, {_VECS},
features as (
  select k, t, j, coalesce(vec[j + 1], 0.0) + {_POSITION} as c
  from cells join vocab using (token) left join vecs using (idx), range(0, 64) g(j) where t < 64)"""

_PAIRS = f"""
{_VOCAB}, {_VECS},
pairs as (
  select 0::bigint as seq_id, a.k, va.vec as a, vb.vec as b
  from cells a join vocab ia on a.token = ia.token join vecs va on va.idx = ia.idx
  join cells b on a.k = b.k and b.t = 64
  join vocab ib on b.token = ib.token join vecs vb on vb.idx = ib.idx
  where a.t = 63)"""

_MEANS = f"""
{_VOCAB}, {_VECS},
means as (
  select k, j, avg(vec[j + 1]) as v
  from cells join vocab using (token) join vecs using (idx), range(0, 64) g(j) where t < 64 group by k, j),
predictions as (select k, list(v order by j) as prediction from means group by k),
sims as (
  select k, idx, round(list_cosine_similarity(prediction, vec), 12) as sim from predictions, vecs),
best as (
  select k, idx, sim from sims where sim > 0.05
  qualify row_number() over (partition by k order by sim desc, idx) = 1)"""

_WORDS = r"""
words as (select doc_id, string_split_regex(trim(text), '\s+') as words from documents)"""

_DOC_WINDOWS = f"""
{_WORDS},
doc_windows as (
  select doc_id, k, words[k * 32 + 1 : k * 32 + 65] as w
  from (select doc_id, words, unnest(range(0, (len(words) - 65) // 32 + 1)) as k from words where len(words) >= 65))"""

_DOC_PAIRS = f"""
with {_DOC_WINDOWS}
select doc_id as seq_id, k, array_to_string(w[1:64], ' ') as input, w[65] as target from doc_windows"""


def _split(share: float) -> str:
    point = "('0x' || substr(md5('0:' || k::varchar), 1, 8))::bigint"
    return f"case when {point} < {share} * 4294967296 then 'train' else 'validation' end"


_SPLIT = _split(0.8)

_INPUT_TEXT = "string_agg(token::varchar, ',' order by t) filter (where t < 64) as input"
_TARGET = "max(token) filter (where t = 64) as target"


_TASK = """
  l_orderkey * 10 + l_linenumber as task_id, l_suppkey::int as stage_id, l_quantity::bigint as duration,
  l_partkey + l_suppkey as shuffle_read_bytes, case when l_linenumber > 1 then l_partkey else 0 end as shuffle_write_bytes,
  l_partkey % 7 = 0 as failed, l_orderkey as peak_execution_memory, l_quantity::bigint * 2 as run_time,
  l_quantity::bigint * 1000000 as cpu_time"""


def _cooccurrences(tables: str, cells: str = "cells") -> str:
    return f"""
      with {tables}
      select ia.idx as a, ib.idx as b, count(*) as n
      from {cells} x join vocab ia on x.token = ia.token join {cells} y on x.k = y.k and y.t = 64 join vocab ib on y.token = ib.token
      where x.t < 64 group by ia.idx, ib.idx"""


def _weights(width: int, hidden: int) -> str:
    """Mean cells as the weights of a model, and where each of its parameters starts."""
    sizes = {"input_weights": 4 * width * hidden, "state_weights": 4 * hidden * hidden, "gate_bias": 4 * hidden}
    sizes |= {"output_weights": hidden * width, "output_bias": width}
    parts, start = [], 0
    for name, size in sizes.items():
        parts.append(f"('{name}', {start}, {start + size})")
        start += size
    return f"""
        parts(param, start, stop) as (values {", ".join(parts)}),
        weights as (
          select (vec_id * 64 + j - 1) % {start} as i, round(avg(x::double), 6) + 0.0 as v
          from (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as j from embeddings) group by 1),
        flat as (select list(v order by i) as f from weights)"""


def _gate(number: int) -> str:
    """One of the eight gate sums of two hidden cells; there is no state before the first place."""
    column = f"[f[j * 8 + {number + 1}] for j in range(0, 64)]"
    return f"list_inner_product(embedding::double[], {column}) + f[{64 * 8 + 16 + number + 1}]"


_PREDICTIONS = f"""
    gates as (select vec_id as k, f, {", ".join(f"{_gate(n)} as g{n}" for n in range(8))} from embeddings, flat),
    cells as (
      select k, f, {", ".join(f"tanh(tanh(g{6 + m}) / (1 + exp(-g{m}))) / (1 + exp(-g{4 + m})) as h{m}" for m in range(2))} from gates),
    predictions as (
      select k, [h0 * f[{536 + 1} + d] + h1 * f[{536 + 64 + 1} + d] + f[{536 + 128 + 1} + d] for d in range(0, 64)] as prediction
      from cells)"""


def oracle_sql() -> dict[str, str]:
    return {
        "read_token_ids": """
            select 0::bigint as seq_id, row_number() over (order by event_id) - 1 as pos, user_id as token
            from events""",
        "tokens_from_table": """
            select conv_id as seq_id, row_number() over (partition by conv_id order by turn) - 1 as pos,
              length(text) as token
            from conversations""",
        "tokens_numbered": f"with {_ORDERS} select 0::bigint as seq_id, pos, token from numbered",
        "window_count": f"""
            with {_LENGTH}
            select 0::bigint as seq_id, n as seq_len, case when n >= 65 then (n - 65) // 32 + 1 else 0 end as windows
            from n""",
        "doc_window_count": f"""
            with {_WORDS}
            select doc_id as seq_id, len(words)::bigint as seq_len,
              case when len(words) >= 65 then (len(words) - 65) // 32 + 1 else 0 end::bigint as windows
            from words""",
        "window_cells": f"with {_CELLS} select 0::bigint as seq_id, k, t::int as t, token from cells",
        "window_cells_sparse": f"""
            with {_ORDERS}, {_SPARSE} select 0::bigint as seq_id, k, t::int as t, token from cells""",
        "window_pairs": f"""
            with {_CELLS} select 0::bigint as seq_id, k, {_INPUT_TEXT}, {_TARGET} from cells group by k""",
        "doc_array_windows": _DOC_PAIRS,
        "doc_window_pairs": _DOC_PAIRS,
        "target_pairs": f"""
            with {_CELLS}
            select 0::bigint as seq_id, a.k, a.t::int as t, a.token, b.token as target
            from cells a join cells b on a.k = b.k and b.t = 64 where a.t < 64""",
        "window_inputs": f"""
            with {_CELLS}
            select 0::bigint as seq_id, k, (count(*) filter (where t < 64))::int as places, {_INPUT_TEXT}
            from cells group by k""",
        "window_labels": f"""
            with {_CELLS} select 0::bigint as seq_id, k, token as target from cells where t = 64""",
        "distinct_tokens": f"""
            with {_CELLS}
            select token, min(case when t = 64 then 1 else 0 end)::int as is_target, 0::bigint as seq_id,
              coalesce(min(k * 32 + t) filter (where t < 64), min(k * 32 + t)) as pos
            from cells group by token""",
        "vocab_index": f"with {_VOCAB} select token, idx from vocab",
        "vocab_index_sparse": f"with {_ORDERS}, {_SPARSE_VOCAB} select token, idx from vocab",
        "doc_vocab_index": f"""
            with {_DOC_WINDOWS},
            cells as (
              select doc_id, k, t, w[t + 1] as token from doc_windows, range(0, 65) g(t)),
            firsts as (
              select token, min((case when t = 64 then 1 else 0 end, doc_id, k, t)) as key from cells group by token)
            select token, row_number() over (order by key) as idx from firsts""",
        "encode_windows": f"""
            with {_VOCAB} select 0::bigint as seq_id, k, t::int as t, idx from cells join vocab using (token)""",
        "lookup_index_oov": f"""
            with {_ORDERS}, {_VOCAB}
            select 0::bigint as seq_id, pos, token, coalesce(idx, -1) as idx from numbered left join vocab using (token)""",
        "decode_index": f"""
            with {_VOCAB}
            select vec_id as idx, coalesce(token, -1) as token from embeddings left join vocab on vec_id = idx""",
        "vocab_size": f"with {_VOCAB} select count(*) + 1 as vocab_size from vocab",
        "index_examples": f"""
            with {_VOCAB}
            select 0::bigint as seq_id, a.k, a.t::int as t, ia.idx::float as input_idx, ib.idx::float as target_idx
            from cells a join vocab ia on a.token = ia.token
            join cells b on a.k = b.k and b.t = 64 join vocab ib on b.token = ib.token
            where a.t < 64""",
        "unindexed_tokens": f"""
            with {_ORDERS}, {_SPARSE}
            select token, count(*) as n from numbered
            where token not in (select token from cells) group by token""",
        "vector_dot": f"""
            with {_PAIRS} select seq_id, k, round(list_inner_product(a, b), 6) + 0.0 as dot from pairs""",
        "vector_cosine": f"""
            with {_PAIRS} select seq_id, k, round(list_cosine_similarity(a, b), 6) + 0.0 as cosine from pairs""",
        "vector_l2": f"""
            with {_PAIRS}
            select seq_id, k, round(sqrt(list_inner_product(a, a)), 6) + 0.0 as norm,
              round(list_distance(a, b), 6) + 0.0 as distance
            from pairs""",
        "vector_add": f"""
            with {_PAIRS}
            select seq_id, k,
              round((list_inner_product(a, {_WIDE}) + list_inner_product(b, {_WIDE})) / 64, 4) + 0.0 as added,
              round(list_inner_product(a, {_WIDE}) / 64, 4) + 0.0 as unchanged,
              round(list_inner_product(list_concat(a, b), range(1, 129)::double[]) / 128, 4) + 0.0
                as flattened
            from pairs""",
        "array_parts": f"""
            with {_CELLS}
            select 0::bigint as seq_id, a.k,
              string_agg(a.token::varchar, ',' order by a.t) filter (where a.t < 3) as first_three,
              max(a.token) filter (where a.t = 63) as last_input,
              count(*)::int as repeats,
              round(sum(a.token::double * b.token::float), 6) + 0.0 as product
            from cells a join cells b on a.k = b.k and b.t = 64 where a.t < 64 group by a.k""",
        "embedding_width": """
            select count(*) as vectors, max(len(embedding))::int as width from embeddings""",
        "positional_encoding": f"""
            select event_id, t::int as t, j::int as j, round({_POSITION}, 6) + 0.0 as value
            from (select event_id, event_id % 64 as t, user_id % 64 as j from events)""",
        "embed_tokens": f"""
            with {_VOCAB}, {_VECS}
            select 0::bigint as seq_id, k, t::int as t, token,
              round(list_inner_product(coalesce(vec, {_ZERO}), {_WIDE}) / 64, 4) + 0.0 as vec_sum
            from cells join vocab using (token) left join vecs using (idx) where t < 64""",
        "embed_target": f"""
            with {_USUAL_WITH_SPARSE_VOCAB}, {_VECS}
            select 0::bigint as seq_id, k, token,
              round(list_inner_product(coalesce(vec, {_ZERO}), {_WIDE}) / 64, 4) + 0.0 as vec_sum
            from usual left join vocab using (token) left join vecs using (idx) where t = 64""",
        "position_aware": f"""
            with {_FEATURES}
            select 0::bigint as seq_id, k, t::int as t, round(sum(c * (j + 1)) / 64, 4) + 0.0 as x_sum
            from features group by k, t""",
        "channel_first": f"""
            with {_FEATURES}
            select 0::bigint as seq_id, k, count(*)::int as cells,
              round(sum(c * (j * 64 + t + 1)) / 4096, 4) + 0.0 as flat_sum
            from features group by k""",
        "training_examples": f"""
            with {_FEATURES},
            sums as (
              select k, count(*)::int as cells, round(sum(c * (j * 64 + t + 1)) / 4096, 4) + 0.0 as features_sum
              from features group by k),
            labels as (
              select k, round(list_inner_product(coalesce(vec, {_ZERO}), {_WIDE}) / 64, 4) + 0.0 as label_sum
              from cells join vocab using (token) left join vecs using (idx) where t = 64)
            select 0::bigint as seq_id, k, cells, features_sum, label_sum from sums join labels using (k)""",
        "window_features": f"""
            with {_FEATURES}
            select 0::bigint as seq_id, k, round(sum(c), 6) + 0.0 as total, round(sum(c * c), 6) + 0.0 as total_sq,
              round(max(c), 6) + 0.0 as largest, count(*) as cells
            from features group by k""",
        "split_examples": f"""
            with {_CELLS}
            select 0::bigint as seq_id, k, token, {_SPLIT} as split from cells where t = 64""",
        "read_token_text_skip": """
            select 0::bigint as seq_id, row_number() over (order by event_id) - 1 as pos, user_id as token
            from events where event_id % 5 in (0, 3, 4)""",
        "task_metrics": f"select {_TASK} from lineitem",
        "resource_use": f"""
            select stage_id, max(peak_execution_memory) as peak_execution_memory,
              round(sum(cpu_time) / 1e6 / sum(run_time), 6) + 0.0 as cpu_ratio
            from (select {_TASK} from lineitem) group by stage_id""",
        "stage_metrics": """
            select o_orderkey::int as stage_id, (o_custkey % 100)::int as num_tasks, o_custkey as duration from orders""",
        "stage_epochs": """
            select stage_id::int as stage_id, min_by(epoch, job)::int as epoch
            from (select o_orderkey as job, o_orderkey % 5 as epoch, unnest([o_custkey, o_custkey + 1]) as stage_id from orders)
            group by stage_id""",
        "recorded_summary": """
            with days as (select o_orderkey % 50 as e, count(*) as n, sum(o_custkey) as c from orders group by 1)
            select count(*) as epochs, sum(n)::bigint as total_ms, min(n) as min_ms, avg(n) as mean_ms, max(n) as max_ms,
              1.0::double / (min(e) + 1) as first_loss, 1.0::double / (max(e) + 1) as last_loss,
              max(e / 64.0::double) as best_training_accuracy, max(e / 128.0::double) as best_validation_accuracy,
              sum(c % 3)::bigint as failed_tasks
            from days""",
        "epoch_metrics": f"""
            with stages as (
              select stage_id, min_by(epoch, job) as epoch
              from (select o_orderkey as job, o_orderkey % 5 as epoch, unnest([o_custkey, o_custkey + 1]) as stage_id from orders)
              group by stage_id),
            tasks as (select epoch, t.* from (select {_TASK} from lineitem) t join stages using (stage_id)),
            averages as (select epoch, avg(duration) as a from tasks group by epoch),
            totals as (
              select epoch, sum(coalesce(shuffle_read_bytes, 0)) as r, sum(coalesce(shuffle_write_bytes, 0)) as w, max(duration) as most,
                min(duration) as least, avg(duration) as mean, count(*) filter (failed) as failed, max(peak_execution_memory) as peak,
                sum(cpu_time) / 1e6 / sum(run_time) as ratio, count(*) filter (duration > 2 * a) as skewed
              from tasks join averages using (epoch) group by epoch),
            log as (select o_orderkey % 7 as epoch, count(*) as n, sum(o_custkey) / 1024.0::double as loss from orders group by 1)
            select epoch::int as epoch, n as duration_ms, 'nan'::double as gradient_variance,
              coalesce(r, 0)::bigint as total_shuffle_read_bytes, coalesce(w, 0)::bigint as total_shuffle_write_bytes,
              coalesce(most, 0)::bigint as max_task_duration, coalesce(least, 0)::bigint as min_task_duration,
              coalesce(failed, 0) as failed_task_count, coalesce(peak, 0)::bigint as peak_execution_memory,
              coalesce(skewed, 0) as skewed_task_count, round(loss, 6) + 0.0 as training_loss,
              round(coalesce(mean, 0), 6) + 0.0 as avg_task_duration, round(coalesce(ratio, 0), 6) + 0.0 as cpu_ratio
            from log left join totals using (epoch)""",
        "saved_model": f"""
            with {_weights(8, 4)}
            select param, (i - start)::int as i, v from weights join parts on i >= start and i < stop""",
        "model_predictions": f"""
            with {_weights(64, 2)}, {_PREDICTIONS}
            select 0::bigint as seq_id, k, len(prediction)::int as cells,
              round(list_inner_product(prediction, [i::double for i in range(1, 65)]) / 64, 4) + 0.0 as prediction_sum
            from predictions""",
        "model_accuracy": f"""
            with {_weights(64, 2)}, {_PREDICTIONS},
            sims as (
              select p.k, e.vec_id as idx, round(list_cosine_similarity(prediction, embedding::double[]), 12) as sim
              from predictions p, embeddings e),
            best as (select k, arg_min(idx, (-sim, idx)) as idx from sims where sim > 0.05 group by k),
            truth as (
              select a.vec_id as k, min(b.vec_id) as idx from embeddings a join embeddings b
                on list_distance(a.embedding::double[], b.embedding::double[]) < 1e-5 group by a.vec_id),
            scored as (
              select e.label as class, coalesce(best.idx % 5 = truth.idx % 5, false) as correct
              from embeddings e left join best on best.k = e.vec_id left join truth on truth.k = e.vec_id)
            select class, count(*) as total, count(*) filter (where correct) as correct,
              round(avg(correct::int::double), 6) + 0.0 as accuracy
            from scored group by class""",
        "split_examples_95": f"""
            with {_CELLS}
            select 0::bigint as seq_id, k, token, {_split(0.95)} as split from cells where t = 64""",
        "cooccurrence_counts": _cooccurrences(_VOCAB),
        "cooccurrence_counts_sparse": _cooccurrences(_USUAL_WITH_SPARSE_VOCAB, "usual"),
        "true_token": f"""
            with {_USUAL_WITH_SPARSE_VOCAB}, {_VECS},
            labels as (
              select k, coalesce(vec, {_ZERO}) as label
              from usual left join vocab using (token) left join vecs using (idx) where t = 64),
            found as (
              select k, min(idx) as true_idx from labels, vecs where list_distance(label, vec) < 1e-5 group by k)
            select 0::bigint as seq_id, k, true_idx, coalesce(token, -1) as true_token
            from labels left join found using (k) left join vocab on vocab.idx = true_idx""",
        "nearest_token": f"""
            with {_MEANS}
            select 0::bigint as seq_id, k, coalesce(idx, -1) as idx, round(sim, 6) + 0.0 as similarity
            from predictions left join best using (k)""",
        "nearest_accuracy": f"""
            with {_MEANS},
            scored as (
              select {_SPLIT} as split, coalesce(p.token = c.token, false) as correct
              from predictions left join best using (k) left join vocab p on p.idx = best.idx
              join cells c using (k) where c.t = 64)
            select split, count(*) as total, count(*) filter (where correct) as correct,
              round(avg(correct::int::double), 6) + 0.0 as accuracy
            from scored group by split""",
        "gradient_stats": """
            select label, round(avg(g), 6) + 0.0 as mean_magnitude, round(max(g), 6) + 0.0 as max_magnitude,
              round(min(g), 6) + 0.0 as min_magnitude, round(coalesce(var_samp(g), 0), 6) + 0.0 as variance
            from (select label, abs(unnest(embedding)::double) as g from embeddings) group by label""",
        "skewed_values": """
            select event_id, round(value, 6) + 0.0 as value from events
            where value > 2 * (select avg(value) from events)""",
        "skewed_values_by_type": """
            select event_id, event_type, round(value, 6) + 0.0 as value
            from events join (select event_type, avg(value) as a from events group by event_type) using (event_type)
            where value > 2 * a""",
        "duration_stats": """
            select event_type, round(max(value), 6) + 0.0 as max_task_duration,
              round(min(value), 6) + 0.0 as min_task_duration, round(avg(value), 6) + 0.0 as avg_task_duration
            from events group by event_type""",
        "shuffle_totals": """
            select l_linenumber as epoch, sum(l_quantity::bigint)::bigint as total_shuffle_read_bytes,
              sum(floor(l_extendedprice)::bigint)::bigint as total_shuffle_write_bytes
            from lineitem group by l_linenumber""",
        "failed_tasks": """
            select l_linenumber as epoch, count(*) filter (where l_returnflag = 'R') as failed_task_count
            from lineitem group by l_linenumber""",
    }
