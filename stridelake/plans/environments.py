"""Robots' environments: what each gives a policy and takes from it, as projections of tables or streams of steps.

Steps hold state, images (a map of camera to image, or any struct of them) and the columns that an environment names.
Hardware and simulators stay outside: they write the stream that these read."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import images as I
from stridelake.operators.filters import required
from stridelake.streaming.playback import episode_progress


@dataclass(frozen=True)
class Environment:
    """cameras: name for the policy by name in images. size: images are resized to fit it and get channels first; without
    one they stay frames of the size that they have. names: columns of the observation, by state and camera.
    completes: whether rows say that an episode is over (terminated or truncated); else it never is."""

    cameras: Mapping[str, str]
    size: tuple[int, int] | None = None
    prompt: str | None = None
    action_dims: int | None = None
    prefix: str = ""
    completes: bool = False

    def observations(self, df: DataFrame, *keep: str) -> DataFrame:
        """keep, state, an image a camera and the prompt. A step without its state or one of the cameras is an error:
        a policy doesn't act on what a sensor said long ago. Depth and other cameras aren't shown."""
        got = lambda c: F.col("images")[c]
        whole = F.col("state").isNotNull()
        for c in self.cameras:
            whole = whole & got(c).isNotNull()
        named = f"{self.prefix}/" if self.prefix else ""
        inside = f"{self.prefix}/images/" if self.prefix else ""
        shown = [(got(c) if self.size is None else I.channels_first(got(c), *self.size)).alias(f"{inside}{name}") for c, name in self.cameras.items()]
        prompt = [] if self.prompt is None else [F.lit(self.prompt).alias("prompt")]
        return required(df, whole, "observation unavailable: a sensor is missing or stale").select(*keep, F.col("state").alias(f"{named}state"), *shown, *prompt)

    def accepted(self, df: DataFrame, column: str = "actions") -> DataFrame:
        """df, whose evaluation raises an error at an action that hasn't the robot's dimensions."""
        return df if self.action_dims is None else required(df, F.size(column) == self.action_dims, f"an action must have {self.action_dims} dimensions")

    def progress(self, df: DataFrame, key: str, order: str, reward: str = "reward") -> DataFrame:
        """episode, done and episode_reward of each step of a table; for streams machines.Runtime counts episodes."""
        done: Column = F.col("terminated") | F.col("truncated") if self.completes else F.lit(False)
        return episode_progress(df, key, order, reward, done)


def _cameras(*pairs: tuple[str, str]) -> Mapping[str, str]:
    return MappingProxyType(dict(pairs))


def dual_arm_real(height: int = 224, width: int = 224) -> Environment:
    """Two arms, four cameras."""
    names = ("cam_high", "cam_low", "cam_left_wrist", "cam_right_wrist")
    return Environment(_cameras(*zip(names, names, strict=True)), (height, width))


def dual_arm_simulated() -> Environment:
    """The simulator's view from the top takes the place of the high camera; episodes end, with their best reward."""
    return Environment(_cameras(("top", "cam_high")), (224, 224), completes=True)


def two_hands(prompt: str) -> Environment:
    """Both generations of the robot with two hands: a state of 48, three views as they come, actions of 16."""
    names = ("left_color", "right_color", "head_camera")
    return Environment(_cameras(*zip(names, names, strict=True)), None, prompt, 16, "observation")
