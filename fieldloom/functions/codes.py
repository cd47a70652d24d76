"""Code tables of the receiving system, and how a text is looked up in one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: these texts and ids must equal those of the receiving system ---

INPUT_TYPE_API = 11

DOOR_CANVASS = 2

CONTACT_TYPES = {
    "getthru_dialer": 19,
    "spoke": 37,
    "bern_app_door_canvass": 2,
    "bern_app_relational": 131,
    "bern_app_crowd_canvass": 139,
}

SUPPORT_CONTACT_TYPES = {
    "getthru_dialer": 19,
    "spoke": 37,
    "bern_app_door_canvass": 2,
    "bern_app_relational": 131,
    "bern_app_crowd_canvass": 139,
    "quickbase": 145,
}

FIRST_CHOICE_QUESTION = 349867
FIRST_CHOICE_TEXT = "Candidate Interest First Choice"
FIRST_CHOICE_ANSWERS = {
    "Amy Klobuchar": 1439386,
    "Andrew Yang": 1439371,
    "Bernie Sanders": 1439388,
    "Beto": 1439370,
    "Bill de Blasio": 1439389,
    "Cory Booker": 1439373,
    "Donald Trump": 1439365,
    "Elizabeth Warren": 1439364,
    "Jay Inslee": 1439385,
    "Joe Biden": 1439366,
    "John Delaney": 1439382,
    "John Hickenlooper": 1439384,
    "Julian Castro": 1439381,
    "Kamala Harris": 1439369,
    "Kirsten Gillibrand": 1439379,
    "Marianne Williamson": 1439376,
    "Michael Bennet": 1439391,
    "Mike Gravel": 1439375,
    "Other": 1439393,
    "Pete Buttigieg": 1439367,
    "Steve Bullock": 1439390,
    "Tim Ryan": 1439392,
    "Tom Steyer": 1439387,
    "Tulsi Gabbard": 1439368,
}

SECOND_CHOICE_QUESTION = 349875
SECOND_CHOICE_TEXT = "Candidate Interest Second Choice"
SECOND_CHOICE_ANSWERS = {
    "Elizabeth Warren": 1439404,
    "Donald Trump": 1439405,
    "Joe Biden": 1439411,
    "Pete Buttigieg": 1439412,
    "Tulsi Gabbard": 1439413,
    "Kamala Harris": 1439414,
    "Beto": 1439415,
    "Andrew Yang": 1439417,
    "Cory Booker": 1439418,
    "Mike Gravel": 1439419,
    "Marianne Williamson": 1439420,
    "Kirsten Gillibrand": 1439421,
    "Julian Castro": 1439422,
    "John Delaney": 1439426,
    "John Hickenlooper": 1439430,
    "Jay Inslee": 1439432,
    "Amy Klobuchar": 1439434,
    "Bernie Sanders": 1439437,
    "Tom Steyer": 1439436,
    "Bill de Blasio": 1439438,
    "Steve Bullock": 1439439,
    "Michael Bennet": 1439440,
    "Other": 1439442,
    "No Answer": 1439443,
}

SUPPORT_QUESTION = 349811
SUPPORT_ANSWERS = {
    "1 - Strong Support": 1439132,
    "2 - Will Likely Support Bernie": 1439133,
    "3 - Undecided": 1439134,
    "4 - Unlikely to Support Bernie": 1439162,
    "5 - Will Not Support Bernie": 1439163,
    "6 - Not Voting / Caucusing in the Democratic Primary": 1439291,
    "7 - Dont know / Wont say": 1439292,
}

VOLUNTEER_QUESTION = 349878
VOLUNTEER_ANSWERS = {
    "Volunteer Yes": 1439463,
    "Volunteer Maybe": 1439464,
    "Volunteer No": 1439465,
}

COMMITTEE_ID = 73296

NOTE_CATEGORIES = {
    "qb_notes": {"IA": 10, "NV": 17, "NH": 9, "SC": 4},
    "polling_location": {"ID": 1},
    "del_app_is_lgbtq": {"PA": 2},
    "del_app_has_disability": {"PA": 3},
    "del_app_union_name": {"PA": 4},
    "del_app_delegate_2016": {"PA": 5},
    "del_app_vol_2016": {"PA": 6},
    "del_app_vol_2020": {"PA": 7},
    "del_app_other_exp": {"PA": 8},
    "del_app_social_media_links": {"PA": 9},
    "del_app_admin_links": {"PA": 10},
    "donation_profession": {"PA": 11, "IL": 2},
}

# --- end of fixed values ---


def lookup(column: Column, table: Mapping[str, int]) -> Column:
    """The id of a text, NULL where the text has none."""
    found = F
    for text, code in table.items():
        found = found.when(column == F.lit(text), F.lit(code))
    return found if table else F.lit(None).cast("int")
