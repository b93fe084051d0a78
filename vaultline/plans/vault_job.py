"""A whole Data Vault from metadata: staging, hubs, links and satellites.

The source-columns sheet names each table's columns (and primary keys); the
mapping sheet's join conditions name the relationships. From them:

- hub per table on its business key: the ``primary_key`` flagged columns, or
  else the first column whose name looks like a key (K1, words mode);
- link per relationship ``child.fk = parent.pk`` (K4), living in the table
  that holds the foreign key, joining the child's and the parent's hubs;
- satellite per table over the remaining columns (K3), keyed by the hub key.

The models are lazy DataFrames; each is one scan of its source with a
partial aggregation (distinct) before its shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from vaultline.operators import vault
from vaultline.operators.catalog import is_key_name
from vaultline.plans.jobs import _rows

_PAIR = re.compile(r"(\w+)\.(\w+)\s*=\s*(\w+)\.(\w+)")


@dataclass
class VaultModel:
    name: str
    kind: str                                   # hub | link | satellite
    source: str
    keys: dict[str, list[str]] = field(default_factory=dict)   # hub name -> key columns in source
    attrs: list[str] = field(default_factory=list)


def vault_models_from_metadata(source_columns, mappings=None) -> list[VaultModel]:
    """Source-columns and mapping sheets (DataFrames or row dicts) -> models."""
    cols: dict[str, list[dict]] = {}
    for r in _rows(source_columns):
        cols.setdefault(r["table_name"], []).append(r)
    business: dict[str, list[str]] = {}
    for t, rs in cols.items():
        flagged = [r["column_name"] for r in rs if r["primary_key"]]
        named = [r["column_name"] for r in rs if is_key_name(r["column_name"])]
        if flagged or named:
            business[t] = flagged or named[:1]
    models = [VaultModel(f"hub_{t}", "hub", t, {t: ks}) for t, ks in business.items()]
    fks: dict[str, set[str]] = {}
    seen = set()
    for m in _rows(mappings):
        for lt, lc, rt, rc in _PAIR.findall(m["join_condition"] or ""):
            # The side whose column is not its own business key holds the foreign key.
            if rc in business.get(rt, []) and lc not in business.get(lt, []):
                child, fk, parent = lt, lc, rt
            elif lc in business.get(lt, []) and rc not in business.get(rt, []):
                child, fk, parent = rt, rc, lt
            else:
                continue
            if child not in business or (child, fk, parent) in seen:
                continue
            seen.add((child, fk, parent))
            fks.setdefault(child, set()).add(fk)
            models.append(VaultModel(f"link_{child}_{parent}", "link", child,
                                     {child: business[child], parent: [fk]}))
    for t, rs in cols.items():
        if t not in business:
            continue
        attrs = [r["column_name"] for r in rs
                 if r["column_name"] not in business[t] and r["column_name"] not in fks.get(t, set())]
        if attrs:
            models.append(VaultModel(f"sat_{t}", "satellite", t, {t: business[t]}, attrs))
    names = [m.name for m in models]
    if len(names) != len(set(names)):
        raise ValueError(f"model names clash: {sorted(n for n in names if names.count(n) > 1)}")
    return models


def build_vault(models: list[VaultModel], sources: Mapping[str, DataFrame], load_ts,
                record_source: str, cleanse: bool = True) -> dict[str, DataFrame]:
    """Lazy DataFrame per model. Sources are staged first (only the columns
    the models use, trimmed, blank -> NULL)."""
    used: dict[str, list[str]] = {}
    for m in models:
        for c in [c for ks in m.keys.values() for c in ks] + m.attrs:
            if c not in used.setdefault(m.source, []):
                used[m.source].append(c)
    staged = {t: vault.staging(sources[t], cs, cleanse=cleanse) for t, cs in used.items()}
    out: dict[str, DataFrame] = {}
    for m in models:
        stg = staged[m.source]
        if m.kind == "hub":
            (name, ks), = m.keys.items()
            out[m.name] = vault.hub(stg, ks, name, load_ts, record_source)
        elif m.kind == "link":
            out[m.name] = vault.link(stg, m.keys, m.name[len("link_"):], load_ts, record_source)
        else:
            (name, ks), = m.keys.items()
            out[m.name] = vault.satellite(stg, ks, m.attrs, name, load_ts, record_source)
    return out
