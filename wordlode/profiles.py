"""Language profiles: delimiters, word patterns, cleaning rules, word rules."""

from __future__ import annotations

from dataclasses import dataclass

from wordlode.functions.text import GB2312, WordRule as R

# Sentence delimiters, cleaning patterns and word rules for Chinese.

ZH_SENTENCE_DELIMITERS = "?!;？！。；…\n"

ZH_CLEANING = [
    "[琴前后这那下上半一二三四五六七八九十甘百千佰仟贰万两叁仨几][束码人头线门块条磅股期注吨起次个支把袋斤两组台箱打颗根张粒朵盒副包瓶双对月年本套顶份套篮本罐桶件床只枚盆扎碗十百千万分季天声升日号]",
    "[一-龥][束码人头线门块条股期注吨起次个支把袋斤两组台箱打颗根张磅粒朵盒副包瓶双对月本套顶份套篮本罐桶件床只枚盆扎碗十百千万分季天声升日号]",
    "[0-9][束码人头线门块条股期注吨起次个支把袋斤两组台箱打颗根张粒朵盒副包瓶双对月本套顶份套篮本罐桶件床只枚盆扎碗十百千万分季天声升日号]",
    "[的了这那到]",
    "[老清][帐婆公账]",
    "[我学会][会说]",
    "[是让请还帮给自][你我己要您]",
    "[不跟行][够发前是对行不]",
    "[补未已己][清上付扣][帐面款除次账]",
    "[补未已己付][清上付扣结]",
    "[亲宝][爱贝][的滴儿]",
    "[今明昨上下晌当][天日午年早晚次]",
    "[相看记还][信错得有]",
    "[支][付][宝]",
    "[星][期][一二三四五六七八日]",
    "[周][一二三四五六七八日]",
    "[感][谢恩]",
    "[供排][养列]",
    "[参工][加资]",
    "[这怎那好][么]",
    "[让进排色][分三球五]",
    "[五六][和合][彩]",
    "[租拿][金去]",
    "[都][是行可要]",
    "[主][持]",
    "[上下][楼车课马班脑样]",
    "[有无][限]",
    "[居果依悠虽][然]",
    "[^一-龥]+",
]

ZH_ANYWHERE = "加一单 加一款 谢谢 微信 什么 标准 地方 热带雨林 一笑而过 普罗旺斯 老板娘 十里桃花 一路有你 朋友圈 博士 硕士 研究生 进一步"

ZH_LAST_CHAR = "课接收湖江间会社洋节为一人给内中后省市局院上所在有与及厂稿下厅部商者从奖出站总路街弄巷口田山区县店馆城个条块单欠班钱室我你他吧吗啦啊乐呢港苑村您呀"
ZH_FIRST_CHAR = "在发带未代要买已再支把袋斤两组台箱打颗根张粒朵欠班支把日号月年转请第每各该个被其从与及当为祝给不买卖借送收先我你他"

ZH_LAST_TWO = """
过户 广场 回来 妈妈 爸爸 上午 下午 晚上 可以 季度 问题 市场 邮件 合约 假设 编号 预算 施加 战略 状况
工作 考核 评估 需求 沟通 阶段 账号 意识 价值 事故 竞争 交易 趋势 主任 价格 门户 治区 培养 职责 社会
主义 办法 干部 员会 商务 发展 原因 情况 国家 园区 伙伴 对手 目标 委员 人员 如下 况下 见图 全国 创新
共享 资讯 队伍 农村 贡献 争力 地区 客户 领域 查询 应用 可以 运营 成员 书记 附近 结果 经理 学位 经营
思想 监管 能力 责任 意见 精神 讲话 营销 业务 总裁 见表 电力 主编 作者 专辑 学报 创建 支持 资助 规划
计划 资金 代表 部门 版社 表明 证明 专家 教授 教师 基金 如图 位于 从事 公司 企业 专业 思路 集团 建设
管理 水平 领导 体系 政务 单位 部分 董事 院士 经济 意义 内部 项目 建设 服务 总部 管理 讨论 改进 文献
"""
ZH_FIRST_TWO = "帮忙 有就 还是 上午 下午 分开 可以 晚上 昨天 今天 明天 爱你 考虑 图中 每个 出席 一个 随着 不会 本次 产生 查询 是否 作者"

ZH_SURNAMES_AT_3 = "毕索嘉宏雷齐付阿余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段漕钱汤尹黎易常武乔贺赖龚文段覃尹房崔季李王张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎"
ZH_PARENTS_AT_3 = "妈爸"
ZH_SURNAMES_AT_2 = "李王张刘陈杨赵黄周吴"
ZH_DIGITS_AT_2 = "一二三四五六七八九十"
ZH_TITLES_AT_3 = "师傅 老板 小姐 老师 女士 先生 年级 张卡 一个 道口"
ZH_WISHES_AT_4 = "节哀 真言 辛苦 运转 财源 风顺 平安 愉快 感谢 感恩 开心 顺利 幸福 阖家 欢乐 福如 寿比 腾达 平步 高升 亨通"

ZH_WORD_RULES = [
    R("must_match", ("[一-龥]",)),
    R("min_len", (2,)),
    R("not_match", ("[较很越增]|[多少大小长短高低好差]",)),
    R("not_contains", tuple(ZH_ANYWHERE.split())),
    R("not_last_char", tuple(ZH_LAST_CHAR)),
    R("not_first_char", tuple(ZH_FIRST_CHAR)),
    R("not_last2", tuple(ZH_LAST_TWO.split())),
    R("not_first2", tuple(ZH_FIRST_TWO.split())),
    R("not_single_repeated"),
    R("not_first_char", tuple(ZH_SURNAMES_AT_3), at_len=3),
    R("not_last_char", tuple(ZH_PARENTS_AT_3), at_len=3),
    R("not_first_char", tuple(ZH_SURNAMES_AT_2), at_len=2),
    R("not_first_char", tuple(ZH_DIGITS_AT_2), at_len=2),
    R("not_last2", tuple(ZH_TITLES_AT_3.split()), at_len=3),
    R("not_contains", tuple(ZH_WISHES_AT_4.split()), at_len=4),
    R("must_match", ("[^一七厂月二夕气产兰丫田洲户尹尸甲乙日卜几口工旧门目曰石闷匕勺]",)),
]

# End of the fixed values.

LATIN_CLEANING = [
    (r"(?i)released under the [a-z]+ licen[sc]e", " "),
    (r"[0-9]+([.,:][0-9]+)*", " "),
    (r"[#$%&*|<>=]+", " "),
    (r"[ \t\r\n]+", " "),
]

LATIN_WORD_RULES = [
    R("must_match", (r"\p{L}",)),
    R("min_len", (2,)),
    R("not_match", (r"[0-9_]",)),
    R("not_contains", ("http", "www", "haha")),
    R("not_last_char", ("q", "v", "j")),
    R("not_first_char", ("ß", "ç")),
    R("not_last2", ("ly", "ed")),
    R("not_first2", ("un", "zz")),
    R("not_single_repeated"),
    R("not_first_char", ("x", "y"), at_len=3),
    R("not_last_char", ("a", "o"), at_len=3),
    R("not_last2", ("os", "as"), at_len=4),
    R("not_contains", ("sh", "th"), at_len=4),
]


@dataclass(frozen=True)
class Profile:
    """What the operators need to know about a script."""

    name: str
    sentence_delimiters: str
    separator: str  # between runs of one script
    spaced: bool  # words are runs; otherwise a dictionary cuts the runs
    joiner: str  # between the words of a phrase
    cleaning: tuple
    word_rules: tuple
    charset: str | None = None  # characters that mined words may hold; any if None


CHINESE = Profile(
    "zh", ZH_SENTENCE_DELIMITERS, "[^一-龥0-9a-zA-Z]+", False, "",
    tuple((p, " ") for p in ZH_CLEANING), tuple(ZH_WORD_RULES), GB2312,
)
LATIN = Profile(
    "latin", ZH_SENTENCE_DELIMITERS + ".", r"[^\p{L}]+", True, " ",
    tuple(LATIN_CLEANING), tuple(LATIN_WORD_RULES),
)
