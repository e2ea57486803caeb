from ledgerlens.sources.tables import combine_shuffle, csv_headers, land_raw, read_table
from ledgerlens.sources.topic import decode_csv, encode_csv, read_topic

__all__ = ["combine_shuffle", "csv_headers", "decode_csv", "encode_csv", "land_raw", "read_table", "read_topic"]
