"""Catalogs: from the options of a read to its table."""

from __future__ import annotations

import importlib
import json
import urllib.parse
import urllib.request
from typing import Any, Protocol

from sedimenta.functions.options import ReadOptions
from sedimenta.sources.iceberg import IcebergTable
from sedimenta.sources.log import VersionedTable


class Catalog(Protocol):
    """Made with the warehouse and the `catalog.` options (`catalog.uri` as uri, `catalog.region` as client.region)."""

    def __init__(self, warehouse: str, properties: dict[str, str]): ...

    def table(self, name: str) -> Any: ...


class FolderCatalog:
    """Versioned tables in warehouse/namespace/name."""

    def __init__(self, warehouse: str, properties: dict[str, str]):
        _no_uri("filesystem", properties)
        self.warehouse = warehouse

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.warehouse, name)


class HadoopCatalog:
    """Iceberg tables in warehouse/namespace/name, with the metadata in each folder."""

    def __init__(self, warehouse: str, properties: dict[str, str]):
        _no_uri("hadoop", properties)
        self.warehouse = warehouse.rstrip("/")

    def table(self, name: str) -> IcebergTable:
        return IcebergTable(f"{self.warehouse}/{name.replace('.', '/')}")


class RestCatalog:
    """The public REST protocol: `catalog.uri` names the service, `catalog.prefix` and `catalog.token` are optional. Every load asks it for the current metadata."""

    def __init__(self, warehouse: str, properties: dict[str, str]):
        if not properties.get("uri"):
            raise ValueError("the rest catalog needs catalog.uri")
        self.uri, self.properties = properties["uri"].rstrip("/"), properties

    def table(self, name: str) -> IcebergTable:
        *space, last = name.split(".")
        quoted = lambda x: urllib.parse.quote(x, safe="")
        path = "/".join([self.uri, "v1", *([self.properties["prefix"]] if self.properties.get("prefix") else []), "namespaces", quoted("\x1f".join(space)), "tables", quoted(last)])
        return RestTable(path, self.properties.get("token"))


class RestTable(IcebergTable):
    def __init__(self, url: str, token: str | None):
        self.url, self.token = url, token
        super().__init__(self._asked()["location"])

    def _asked(self) -> dict:
        headers = {"Authorization": f"Bearer {self.token}"} if self.token else {}
        with urllib.request.urlopen(urllib.request.Request(self.url, headers=headers), timeout=60) as r:
            return json.load(r)["metadata"]

    def load(self) -> dict[str, Any]:
        self.given = self._asked()
        return super().load()


def _no_uri(name: str, properties: dict[str, str]) -> None:
    if properties.get("uri"):
        raise ValueError(f"catalog.uri has no meaning for the {name} catalog; the table would be another one")


#: By option value. Others name a class of this protocol, as module:Class.
CATALOGS: dict[str, type] = {
    "filesystem": FolderCatalog,
    "hadoop": HadoopCatalog, "org.apache.iceberg.hadoop.HadoopCatalog": HadoopCatalog,
    "rest": RestCatalog, "org.apache.iceberg.rest.RESTCatalog": RestCatalog,
}


def load(o: ReadOptions) -> Any:
    """The table that the options name; an implementation that isn't known is an error."""
    kind = CATALOGS.get(o.catalog_impl)
    if kind is None:
        module, colon, name = o.catalog_impl.partition(":")
        if not colon:
            raise ValueError(f"catalog-impl: {o.catalog_impl!r} is none of {sorted(CATALOGS)} and no module:Class")
        kind = getattr(importlib.import_module(module), name)
    return kind(o.warehouse, o.catalog).table(o.table)
