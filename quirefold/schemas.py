"""Schemas of the tables that the operators exchange, as DDL."""

SPANS = "array<struct<s:int,e:int>>"
TOKEN = "ord int, kind string, value string, line int, col int"
SECTION = "struct<n:int,title:string,combined:boolean,combined_with:int>"
VERSE = f"struct<section:int,verse:int,text:string,italics:{SPANS},macros_seen:array<string>,floater:boolean,ord:int>"
#: One extracted paper; ``error`` is set, and the rest empty, where parsing failed.
PAPER = f"path string, paper int, title string, subtitle string, author string, sections array<{SECTION}>, verses array<{VERSE}>, error string"
DEVIATION = "paper int, section int, verse int, skip boolean, ignore_italics boolean, reason string, expect_tex string, expect_srt string"
WORD = "doc string, page int, flow int, block int, line int, word int, text string, xMin double, xMax double, yMin double, yMax double"
BBOX_PAGE = (
    "_width double, _height double, flow array<struct<block:array<struct<line:array<struct<"
    "_xMin:double,_yMin:double,_xMax:double,_yMax:double,word:array<struct<_VALUE:string,_xMin:double,_yMin:double,_xMax:double,_yMax:double>>>>>>>>"
)
