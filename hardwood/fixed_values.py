"""Names, codes and weights that the input formats prescribe."""

# --- fixed values: texts in a minutes or count column that mean "no numbers for this game"
DID_NOT_PLAY = ["Did Not Play", "Did Not Dress", "Not With Team", "Player Suspended"]

# --- fixed values: address of a month page, by the two digits of the year and the month
MONTH_PAGE = "/leagues/NBA_%s_games-%s.html"

# --- fixed values: raw box-score columns
BOX_COLUMNS = [
    "Player", "Date", "Team", "Against", "Home",
    "MP", "FG", "FGA", "FG%", "3P", "3PA", "3P%", "FT", "FTA", "FT%",
    "ORB", "DRB", "TRB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "+/-",
]
BOX_STATS = BOX_COLUMNS[5:]

# --- fixed values: columns that are not features of a player's window
NOT_FEATURES = ["Player", "GameLink", "FDP", "FG%", "3P%", "FT%", "TRB", "+/-"]

# --- fixed values: feed header -> column name
FEED_COLUMNS = {
    "GID": "GID",
    "Last, First": "Player",
    "Date": "Date",
    "Team": "Team",
    "Opp": "Against",
    "H/A": "Home",
    "GameID": "GameID",
    "GTime(ET)": "GameTime",
    "Team pts": "TeamPoints",
    "Opp pts": "OppPoints",
    "Start": "Starting",
    "Minutes": "Minutes",
    "GP": "Appeared",
    "active": "Active",
    "FDP": "FDP",
    "DKP": "DKP",
    "DDP": "DDP",
    "YHP": "YHP",
    "Stats": "Stats",
    "DoubleD": "DoubleD",
    "TripleD": "TripleD",
    "FD Sal": "FDSal",
    "FD Change": "FDChange",
    "DK Sal": "DKSal",
    "DK Change": "DKChange",
    "DD Sal": "DDSal",
    "DD Change": "DDChange",
    "YH Sal": "YHSal",
    "YH Change": "YHChange",
    "FD pos": "FDPos",
    "DK pos": "DKPos",
    "DD pos": "DDPos",
    "YH pos": "YHPos",
}
# The feed itself has one more column, the name in reading order.
FEED_HEADER = list(FEED_COLUMNS)[:2] + ["First  Last"] + list(FEED_COLUMNS)[2:]

# --- fixed values: entries skipped when a data folder is listed
IGNORED_ENTRIES = ["cleaned", "txt-files", ".ipynb_checkpoints", "ipynb_checkpoints", "shifted"]

# --- fixed values: misspelt team names left by a split on "at"
TEAM_ALIASES = {
    "Se": "Seattle SuperSonics",
    "tle SuperSonics": "Seattle SuperSonics",
    "Golden St": "Golden State Warriors",
    "e Warriors": "Golden State Warriors",
    "Miami H": "Miami Heat",
    "Miami He": "Miami Heat",
    "s": "Charlotte Bobcats",
}

# --- fixed values: team name -> code
TEAM_CODES = {
    "Atlanta Hawks": "Atl",
    "Boston Celtics": "Bos",
    "Brooklyn Nets": "Bkn",
    "Charlotte Hornets": "Cha",
    "Chicago Bulls": "Chi",
    "Cleveland Cavaliers": "Cle",
    "Dallas Mavericks": "Dal",
    "Denver Nuggets": "Den",
    "Detroit Pistons": "Det",
    "Golden State Warriors": "GSW",
    "Houston Rockets": "Hou",
    "Indiana Pacers": "Ind",
    "Los Angeles Lakers": "LAL",
    "Los Angeles Clippers": "LAC",
    "Memphis Grizzlies": "Mem",
    "Miami Heat": "Mia",
    "Milwaukee Bucks": "Mil",
    "Minnesota Timberwolves": "Min",
    "New Orleans Pelicans": "Nor",
    "New York Knicks": "NYK",
    "Oklahoma City Thunder": "OKC",
    "Orlando Magic": "Orl",
    "Philadelphia 76ers": "Phi",
    "Phoenix Suns": "Pho",
    "Portland Trail Blazers": "Por",
    "Sacramento Kings": "Sac",
    "San Antonio Spurs": "SAS",
    "Toronto Raptors": "Tor",
    "Utah Jazz": "Uta",
    "Washington Wizards": "Was",
}

# --- fixed values: months with games, by kind of season
SEASON_MONTHS = {
    0: ["october", "november", "december", "january", "february", "march", "april", "may", "june"],
    1: ["november", "december", "january", "february", "march", "april", "may", "june"],
    2: ["december", "january", "february", "march", "april", "may", "june"],
    3: ["october-2019", "november", "december", "january", "february", "march",
        "july", "august", "september", "october-2020"],
    4: ["december", "january", "february", "march"],
}
# --- fixed values: anchor texts that are month links on a season page
MONTH_LINK_TEXTS = [
    "september", "october", "november", "december", "january",
    "february", "march", "april", "may", "june",
]

# --- fixed values: fantasy score per counted event, by book
SCORE_BOOKS = {
    "FDP": {"3P": 3.0, "FG": 2.0, "FT": 1.0, "TRB": 1.2, "AST": 1.5, "BLK": 3.0, "STL": 3.0, "TOV": -1.0},
}

# --- fixed values: position digit -> label
POSITIONS = {1: "PG", 2: "SG", 3: "SF", 4: "PF", 5: "C"}

# --- fixed values: suffixes of the stat string -> column
STAT_SUFFIXES = {
    "pt": "Pts",
    "rb": "Rbs",
    "as": "Ass",
    "st": "Stl",
    "bl": "Bl",
    "to": "To",
    "trey": "Trey",
    "fg": "FG",
    "ft": "FT",
}
