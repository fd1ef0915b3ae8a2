"""Row, load and benchmark operators over DataFrames."""
