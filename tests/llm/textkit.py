"""What the tests of this folder share."""

import os
import re

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = ("The river ran past the old mill and the people of the town came down to it every morning. "
         "They talked about the weather, the harvest and the road over the hills. Nobody was in a hurry. ")
