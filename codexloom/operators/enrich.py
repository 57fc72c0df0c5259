"""Optional enrichment of documents by a generating model, and the sets that external tools have still to work on."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import records


def json_in(text: str | None) -> dict:
    """The first JSON object in a noisy reply, {} if there is none."""
    decoder = json.JSONDecoder()
    for at in (i for i, ch in enumerate(text or "") if ch == "{"):
        try:
            found, _ = decoder.raw_decode(text[at:])
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    return {}


def generate_items(prompts: DataFrame, generate: Callable[[str], str]) -> DataFrame:
    """Items of model replies to prompts (document_id, prompt): document_id, item_id, field, statement,
    evidence_block_ids, error. A failing call becomes one row with its error, and the batch goes on."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for document, prompt in zip(pdf.document_id, pdf.prompt):
                try:
                    reply = json_in(generate(prompt))
                except Exception as error:  # noqa: BLE001 - one document must not end the batch
                    rows.append((document, f"{document}:error", None, None, [], f"{type(error).__name__}: {error}"[:200]))
                    continue
                for field, items in sorted(reply.items()):
                    for n, item in enumerate(items if isinstance(items, list) else []):
                        if isinstance(item, dict) and str(item.get("statement") or "").strip():
                            ids = [str(b) for b in item.get("evidence_block_ids") or []]
                            rows.append((document, f"{document}:{field}:{n}", field, str(item["statement"]).strip(), ids, None))
            yield pd.DataFrame(rows, columns=["document_id", "item_id", "field", "statement", "evidence_block_ids", "error"])

    return prompts.mapInPandas(ask, "document_id string, item_id string, field string, statement string, evidence_block_ids array<string>, error string")


def enriched_statements(prompts: DataFrame, blocks: DataFrame, statements: DataFrame, generate: Callable[[str], str] | None) -> DataFrame:
    """Statements (document_id, field, statement, support_status): the model's where all their evidence exists; documents
    without any such item, and all without a model, keep the extracted ones."""
    extracted = statements.select("document_id", "field", "statement", F.lit("supported").alias("support_status"))
    if generate is None:
        return extracted
    items = generate_items(prompts, generate).where("error is null")
    kept = records.cited_items(items, blocks).select("document_id", "field", "statement", "support_status")
    return kept.unionByName(extracted.join(kept.select("document_id").distinct(), "document_id", "left_anti"))


def pending_extraction(manifest: DataFrame, finished: DataFrame, force: bool = False) -> DataFrame:
    """Selected, extractable PDFs that the parser has not finished (all of them if forced)."""
    chosen = manifest.where((F.col("format") == "pdf") & F.col("selected_for_extraction") & F.coalesce("extractable", F.lit(True)))
    return chosen if force else chosen.join(finished.select("document_id").distinct(), "document_id", "left_anti")


def prunable(outputs: DataFrame, finished: DataFrame, root: str) -> DataFrame:
    """Intermediate folders (document_id, path) that may be deleted: finished, and direct children of the raw root."""
    direct = F.regexp_replace("path", "/+$", "").rlike("^" + root.rstrip("/").replace(".", r"\.") + "/[^/]+$")
    return outputs.where(direct).join(finished.select("document_id").distinct(), "document_id", "left_semi")


def renamed_assets(assets: DataFrame, policy: str = "figures") -> DataFrame:
    """Assets (document_id, path, content) to keep under a policy (none, figures, all) and their names with a hash."""
    if policy not in ("none", "figures", "all"):
        raise ValueError(f"unknown asset policy {policy!r}")
    image = F.lower("path").rlike(r"\.(png|jpe?g|gif|webp|svg)$")
    kept = assets.where("false") if policy == "none" else assets.where(image) if policy == "figures" else assets
    stem, suffix = F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1), F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 2)
    return kept.select("document_id", "path", F.concat(stem, F.lit("_"), F.left(F.sha2("content", 256), F.lit(10)), suffix).alias("name"))
