"""Table operators: marts, joins, intake, versions, exports, partitions."""
