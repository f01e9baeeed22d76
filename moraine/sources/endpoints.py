"""The response families a lake holds."""

from __future__ import annotations

from dataclasses import dataclass

# Partition folder name, endpoint template.
LANDING = "landing"
BOXSCORE = "boxscore"
PLAY_BY_PLAY = "play-by-play"
ROSTER = "roster"
CLUB_SCHEDULE = "club-schedule-season"
SKATER_SUMMARY = "skater-summary"
GOALIE_SUMMARY = "goalie-summary"
TEAM_SUMMARY = "team-summary"
SCHEDULE = "schedule"

TEMPLATES = {
    LANDING: "/v1/gamecenter/{gameId}/landing",
    BOXSCORE: "/v1/gamecenter/{gameId}/boxscore",
    PLAY_BY_PLAY: "/v1/gamecenter/{gameId}/play-by-play",
    ROSTER: "/v1/roster/{team}/{season}",
    CLUB_SCHEDULE: "/v1/club-schedule-season/{team}/{season}",
    SKATER_SUMMARY: "/stats/rest/en/skater/summary",
    GOALIE_SUMMARY: "/stats/rest/en/goalie/summary",
    TEAM_SUMMARY: "/stats/rest/en/team/summary",
    SCHEDULE: "/v1/schedule/{date}",
}

GAME_FAMILIES = (LANDING, BOXSCORE, PLAY_BY_PLAY)
TEAM_SEASON_FAMILIES = (ROSTER, CLUB_SCHEDULE)
SUMMARY_FAMILIES = (SKATER_SUMMARY, GOALIE_SUMMARY, TEAM_SUMMARY)

# Finished game states, competitive game types.
FINISHED_STATES = ("FINAL", "OFF")
COMPETITIVE_TYPES = (2, 3)

# Phases in the order they run, and the families each loads.
PHASE_FAMILIES = {
    "team-season": TEAM_SEASON_FAMILIES,
    "season-summaries": SUMMARY_FAMILIES,
    "games": GAME_FAMILIES,
}


@dataclass(frozen=True)
class LakePaths:
    """Where one lake lives. Any file system Spark can reach will do."""

    base: str

    def family(self, family: str) -> str:
        return f"{self.base.rstrip('/')}/{family}"

    @property
    def manifest(self) -> str:
        return f"{self.base.rstrip('/')}/_manifests/ingest_runs"

    def rejects(self, family: str) -> str:
        return f"{self.base.rstrip('/')}/_rejects/{family}"


def templates_of(families) -> list[str]:
    return [TEMPLATES[f] for f in families]
