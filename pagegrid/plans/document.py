"""The three profiles, from page objects to their results. Cells that are read several times are written once to the shared folder; all else is lazy."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagegrid.operators import cells as C
from pagegrid.operators import headers as H
from pagegrid.operators import lattice as L
from pagegrid.operators.lattice_pages import merged_cells
from pagegrid.runtime import scratch_table
from pagegrid.schema import BOX, P, Config, split_nulls
from pagegrid.sources.page_objects import page_subset


class Documents:
    """Ruled pages of many documents: cells, rows, columns, header row and table structure."""

    def __init__(self, frames: dict[str, DataFrame], pages: list[int] | None = None, config: Config = Config(), embedder: H.TextEmbedder | None = None):
        self.frames, self.config, self.embedder = page_subset(frames, pages), config, embedder

    @cached_property
    def _checked(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        return {n: split_nulls(self.frames[n], n) for n in ("chars", "segments", "rects")}

    def found_cells(self) -> DataFrame:
        """The cells, for one reader: nothing is written."""
        return C.cells(self.frames["pages"], self._checked["chars"][0], self._checked["segments"][0], self.config.tol, self.config.clean_chars)

    @cached_property
    def cells(self) -> DataFrame:
        return scratch_table(self.found_cells(), "cells")

    @cached_property
    def rows(self) -> DataFrame:
        return C.document_order(C.groups(self.cells, "row", self.config.row_tol), "row")

    @cached_property
    def columns(self) -> DataFrame:
        return C.document_order(C.groups(self.cells, "column", self.config.row_tol), "column")

    def get_rows(self, page_number: int | None = None) -> DataFrame:
        return self.rows if page_number is None else self.rows.where(F.col("page_number") == page_number)

    def get_columns(self, page_number: int | None = None) -> DataFrame:
        return self.columns if page_number is None else self.columns.where(F.col("page_number") == page_number)

    @cached_property
    def header_row(self) -> DataFrame:
        return H.header_rows(self.rows, self.config.threshold, self.embedder)

    @cached_property
    def table_structure(self) -> DataFrame:
        return H.table_structure(self.header_row)

    def counts(self) -> DataFrame:
        """doc_id, page_number, cells, rows, columns: how many there are on each page that has cells."""
        out = self.cells.groupBy(*P).agg(F.count("*").alias("cells"))
        for name, found in (("rows", self.rows), ("columns", self.columns)):
            out = out.join(found.groupBy(*P).agg(F.count("*").alias(name)).hint("merge"), P)
        return out

    def body(self) -> DataFrame:
        """doc_id, header, rows: a document's rows below its header, in order."""
        row = F.struct("ordinal", "texts")
        head = self.header_row.select("doc_id", F.col("ordinal").alias("head"), F.col("texts").alias("header"))
        body = self.rows.join(head.hint("merge"), "doc_id").where("ordinal > head")
        return body.groupBy("doc_id", "header").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["texts"]).alias("rows"))

    def errors(self) -> DataFrame:
        """doc_id, stage, message: objects without coordinates, and documents without a header."""
        out = H.missing_headers(self.frames["pages"].select("doc_id").distinct(), self.header_row)
        for _, found in self._checked.values():
            out = out.unionByName(found)
        return out


class LatticePages:
    """Pages whose grid has gaps: linked cells, and the rows, columns and grids they connect to.

    Cells are linked anew after small ones were merged, so no link leads to a cell that is gone
    or that has grown away.
    """

    def __init__(self, frames: dict[str, DataFrame], config: Config = Config()):
        self.frames, self.config = frames, config

    @cached_property
    def lines(self) -> DataFrame:
        f = self.frames
        cleaned = scratch_table(L.clean_lines(L.all_lines(f["segments"], f["rects"]), f["pages"], self.config), "lines")
        return scratch_table(L.finalise_lines(cleaned, self.config), "lines")  # read for each side of the boxes

    @cached_property
    def found_cells(self) -> DataFrame:
        return L.lattice_cells(self.lines, self.frames["chars"].select(*P, "seq", "text", *BOX), self.config)

    def merged_cells(self) -> DataFrame:
        """found_cells after small ones were merged, for one reader: nothing is written."""
        return merged_cells(self.frames, self.config)

    @cached_property
    def cells(self) -> DataFrame:
        return scratch_table(self.merged_cells(), "lattice")

    @cached_property
    def links(self) -> DataFrame:
        return L.link_cells(self.cells, self.config.tol)

    def rows(self) -> DataFrame:
        return L.rows(self.cells, self.links)

    def columns(self) -> DataFrame:
        return L.columns(self.cells, self.links)

    def grids(self) -> DataFrame:
        return L.grids(self.cells, self.links)


def header_blocks(frames: dict[str, DataFrame], config: Config = Config(), embedder: H.TextEmbedder | None = None) -> DataFrame:
    """The best header blocks of unbordered documents."""
    return H.header_blocks(frames["chars"], frames["segments"], config, embedder)
