from tidemark.sources.extract import changed_since, extract
from tidemark.sources.files import CsvFolder, Frames, load_csv
from tidemark.sources.jdbc import JdbcDatabase
from tidemark.sources.marks import high_water_mark, latest_of, layer_mark, record_mark, recorded_mark

__all__ = [
    "CsvFolder", "Frames", "JdbcDatabase", "changed_since", "extract",
    "high_water_mark", "latest_of", "layer_mark", "load_csv", "record_mark", "recorded_mark",
]
