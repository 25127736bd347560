"""One explicit schema per table; nothing is inferred from data."""

from pyspark.sql import types as T


def _table(**columns):
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


STR, LONG, DBL = T.StringType(), T.LongType(), T.DoubleType()

# What is read of the raw files, by name.  Ids arrive as text where the source is not trusted.
RAW_ARTISTS = _table(id=STR, name=STR, url=STR, pictureURL=STR)
RAW_INTERACTIONS = _table(userID=LONG, artistID=LONG, weight=DBL)
RAW_TAGS = _table(tagID=STR, tagValue=STR)
RAW_TAG_ASSIGNMENTS = _table(userID=LONG, artistID=STR, tagID=STR)

# Prepared tables.
CATALOG = _table(artist_id=LONG, artist=STR, url=STR, musicnet_id=LONG)
RECORDING_MAP = _table(
    artist_id=LONG, artist=STR, musicnet_id=LONG, composer_raw=STR, match_key=STR, match_type=STR
)
RATINGS = _table(user_id=LONG, artist_id=LONG, artist=STR, rating=DBL)
LABELLED_RATINGS = T.StructType([*RATINGS.fields, T.StructField("is_test", T.BooleanType(), True)])
TAG_PAYLOADS = _table(artist_key=STR, payload=STR, status=STR)
TAG_CACHE = _table(artist_key=STR, tags=T.ArrayType(STR))
RECORDING_IDS = _table(musicnet_id=LONG)
EXTRACTION_ERRORS = _table(musicnet_id=LONG, error=STR)

# Column names of the raw files, once lower-cased, in the names used from there on.
STANDARD_NAMES = {
    "artists": {"id": "artist_id", "name": "artist", "pictureurl": "picture_url"},
    "interactions": {"userid": "user_id", "artistid": "artist_id"},
    "tags": {"tagid": "tag_id", "tagvalue": "tag_name"},
    "tag_assignments": {"userid": "user_id", "artistid": "artist_id", "tagid": "tag_id"},
    "recordings": {"id": "musicnet_id", "composer": "composer_raw"},
}
