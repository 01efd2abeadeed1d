"""Analytics for sequencing samples on Spark: sheets, read quality, versions, parameters, reports."""
