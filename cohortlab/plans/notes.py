"""Default texts of the note columns; every model takes its own through a parameter."""

COHORT_NOTE = "Pooled continuous cycles: results extend the cited study and do not repeat its design."
SOURCE_NOTE = "Shares follow the first digit of the food code; groups of unclear origin stay unclassified."
FLOW_NOTE = "Pooled continuous cycles: for validation and extension of the cited study only."
CATALOG_NOTE = "Cycles from 2003 on; the cited study of 2014 rests on an earlier survey wave."
LINKAGE_NOTE = "Linked mortality is published per cycle; the newest public release of a cycle is used."
